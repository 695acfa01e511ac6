"""Token counts of whole texts from prefix tables, and what they answer: totals, budgets, truncation.

The byte-level BPE first cuts a text into pieces (the published pattern), then encodes each piece. Of each distinct piece the prefix table (bpe_prefix) is filled once, and the ends of its
tokens, read off it backwards, are kept in a bounded memo, so common words cost one look-up. One pass over a text strings these ends together (Prefixes); the total, the tokens of
any prefix, and where a budget of tokens ends are all read off there, and nothing is cut or encoded again.

Cases: null text counts as empty: 0 bytes, 0 tokens; repeated rows give repeated results; long texts are taken whole; texts without white space are one piece, whose
table is linear in its length; special strings are one token each, as the library counts them; other columns don't take part.
"""

from __future__ import annotations

import json
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.bpe_prefix import PrefixTable
from changeloom.llm.common import table

LIMIT = 512
MEMO = 400_000
#: White space as the library's pattern engine takes it; fixed values.
SPACE = r"\t-\r \x85\xa0  -     　"
PIECES = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins that vocabulary files of this kind write for bytes: printable Latin-1 for itself, the rest from 256 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


class Prefixes:
    """What a text's pieces have: each one's string, and the ends of its tokens in bytes from its own start, the last of which is its length."""

    def __init__(self, pieces: list[str], ends: list[tuple[int, ...]]):
        self.pieces, self.ends = pieces, ends
        self.n_tokens = sum(map(len, ends))

    def fitting(self, limit: int) -> int:
        """Bytes of the longest run of the text's own first tokens that has at most ``limit`` tokens, cut between characters."""
        n_bytes = n_tokens = 0
        for piece, ends in zip(self.pieces, self.ends, strict=True):
            if n_tokens + len(ends) > limit:
                inside, raw = ends[limit - n_tokens - 1] if limit > n_tokens else 0, piece.encode()
                while inside and raw[inside] & 0xC0 == 0x80:
                    inside -= 1
                return n_bytes + inside
            n_bytes, n_tokens = n_bytes + ends[-1], n_tokens + len(ends)
        return n_bytes

    def tokens_within(self, n_bytes: int) -> int:
        """How many of the text's own tokens lie wholly in its first n_bytes."""
        so_far = list(accumulate((e[-1] for e in self.ends), initial=0))
        k = bisect_right(so_far, n_bytes) - 1
        return sum(map(len, self.ends[:k])) + (bisect_right(self.ends[k], n_bytes - so_far[k]) if k < len(self.ends) else 0)


class Counter(dict):
    """piece -> the ends of its tokens in bytes, through a bounded memo."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbols = {s: chr(b) for s, b in byte_symbols().items()}
        raw = lambda s: "".join(symbols[c] for c in s)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        order = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        self.table = PrefixTable(map(raw, set(spec["model"]["vocab"]) - set(self.special)), lambda a, b: order.get((a, b)))
        self.pattern = regex.compile(PIECES)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def __missing__(self, piece: str) -> tuple[int, ...]:
        lengths = self.table.lengths
        ends = tuple(accumulate([lengths[t] if t >= 0 else 1 for t in self.table.numbers(piece.encode().decode("latin-1"))]))
        if len(piece) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[piece] = ends
        return ends

    def prefix_counts(self, piece: str) -> list[int]:
        """Tokens of each prefix of the piece, by its UTF-8 bytes."""
        return self.table.counts(piece.encode().decode("latin-1"))

    def _parts(self, text: str) -> Iterator[tuple[str, bool]]:
        if not self.cut or not any(s in text for s in self.special):
            yield text, False
            return
        at = 0
        for m in self.cut.finditer(text):
            yield text[at : m.start()], False
            yield m[0], True
            at = m.end()
        yield text[at:], False

    def prefixes(self, text: str) -> Prefixes:
        pieces: list[str] = []
        ends: list[tuple[int, ...]] = []
        for part, special in self._parts(text):
            found = [part] if special else self.pattern.findall(part)
            pieces += found
            ends += [(len(part.encode()),)] if special else map(self.__getitem__, found)
        return Prefixes(pieces, ends)

    def count(self, text: str) -> int:
        return self.prefixes(text).n_tokens


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = LIMIT, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_bytes, n_tokens, over_limit, and fitting_bytes (how many bytes the first ``limit`` tokens cover).

    vocabulary: path of the file; None finds byte_bpe_50k.json of the installed public tokenizers where the task runs.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        c = counter(vocabulary or public_tokenizers.path("byte_bpe_50k.json"))
        for batch in batches:
            texts = batch["text"].fillna("")
            n_bytes = [len(t.encode()) for t in texts]
            n_tokens, fits = [], []
            for t, b in zip(texts, n_bytes, strict=True):
                p = c.prefixes(t)
                n_tokens.append(p.n_tokens)
                fits.append(b if p.n_tokens <= limit else p.fitting(limit))
            yield pd.DataFrame({"key": batch["key"], "n_bytes": n_bytes, "n_tokens": n_tokens, "over_limit": [n > limit for n in n_tokens], "fitting_bytes": fits})

    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    out = source.mapInPandas(count, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean, fitting_bytes long")
    return out.withColumnRenamed("key", key)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
