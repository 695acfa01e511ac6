"""Exact byte-pair encoding by prefix dynamic programming.

For every prefix of a string there is one token that its encoding ends with. It is the one token t, among those that match there, for
which t is compatible with the last token of the prefix before t: the two, joined and merged by themselves, stay these two.
(Merges inside two neighbours go on independently until the first merge across them, so a sequence is an encoding when all
neighbours are compatible.) A table of last tokens, filled from left to right, therefore holds the encoding of every prefix: ids are
recovered backwards, and counts add up forwards.

Nothing here knows of texts: a piece is a string of symbols, bytes as latin-1 characters or code points.
"""

from __future__ import annotations

from collections.abc import Callable

import ahocorasick


def merged(symbols: list[str], rank: Callable[[str, str], float | None]) -> list[str]:
    """Plain merging: again and again the neighbours of lowest rank, leftmost first. For short strings."""
    parts = list(symbols)
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = rank(parts[i], parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if best is None:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class PrefixTable:
    """Last tokens of all prefixes, for one vocabulary.

    tokens: all strings that may be tokens. rank(a, b): order of the merge of a with b, None if they don't merge. A symbol that no
    token ends with is a token of its own, with number -1.
    """

    def __init__(self, tokens, rank, memo: int = 400_000):
        self.rank, self.limit = rank, memo
        # a token that merging doesn't give for its own string is in no encoding
        self.names = [t for t in dict.fromkeys(tokens) if len(t) == 1 or merged(list(t), rank) == [t]]
        self.n = len(self.names)
        self.lengths = list(map(len, self.names))
        self.automaton = ahocorasick.Automaton()
        for i, t in enumerate(self.names):
            self.automaton.add_word(t, (i, len(t)))
        self.automaton.make_automaton()
        self.pairs: dict[int, bool] = {}

    def compatible(self, a: int, b: int) -> bool:
        if len(self.pairs) >= self.limit:
            self.pairs.clear()
        x, y = self.names[a], self.names[b]
        fits = self.pairs[a * self.n + b] = merged(list(x + y), self.rank) == [x, y]
        return fits

    def last(self, piece: str) -> list[int]:
        """At 1, 2, ... the number of the last token of the prefix of so many symbols; at 0 nothing."""
        table = [-1] * (len(piece) + 1)
        pairs, n = self.pairs, self.n
        for end, (token, length) in self.automaton.iter(piece):  # by place, the longest first, which most often is the one
            end += 1
            if table[end] < 0:
                start = end - length
                before = table[start]
                if before < 0:  # the beginning, or a symbol that merges with nothing
                    table[end] = token
                else:
                    fits = pairs.get(before * n + token)
                    if fits or fits is None and self.compatible(before, token):
                        table[end] = token
        return table

    def counts(self, piece: str) -> list[int]:
        """Tokens of each prefix of 1, 2, ... symbols."""
        out, lengths = [0], self.lengths
        for end, token in enumerate(self.last(piece)[1:], 1):
            out.append(1 + out[end - (lengths[token] if token >= 0 else 1)])
        return out[1:]

    def numbers(self, piece: str) -> list[int]:
        """The tokens' numbers, recovered backwards; ~code point for a symbol without one."""
        table, end, out, lengths = self.last(piece), len(piece), [], self.lengths
        while end:
            token = table[end]
            if token >= 0:
                out.append(token)
                end -= lengths[token]
            else:
                out.append(~ord(piece[end - 1]))
                end -= 1
        out.reverse()
        return out

    def encode(self, piece: str) -> list[str]:
        return [self.names[t] if t >= 0 else chr(~t) for t in self.numbers(piece)]
