"""SentencePiece encoding and decoding by a merge-type prefix table.

A text is normalised as the model says (a dummy prefix, spaces as U+2581), cut where no piece of the vocabulary crosses, and each chunk is
encoded by the table of its prefixes' last tokens (bpe_prefix), ids recovered backwards. Characters that no piece holds fall back to their bytes. Chunks and what they
decode to are kept in a bounded memo.

Cases: null text is the empty text, which has the end id alone; repeated rows give repeated results; long texts are taken whole; a text
without spaces is one chunk, whose table is linear in its length; U+2581 in a text is decoded as a space, as the library does; other columns don't take part.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeloom.llm.bpe_prefix import PrefixTable
from changeloom.llm.common import table

MEMO = 150_000
SPACE = "▁"


class Codec(dict):
    """chunk -> (ids joined by spaces, its text after decoding)."""

    def __init__(self, path: str):
        super().__init__()
        import sentencepiece

        # the library reads the model file; encoding and decoding are done here
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        plain = [i for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.ids = {model.id_to_piece(i): i for i in plain}
        self.byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.surfaces = {i: p for p, i in self.ids.items()}
        self.bytes_of = {i: b for b, i in self.byte_ids.items()}
        self.end = model.eos_id()
        scores = {p: -model.get_score(i) for p, i in self.ids.items()}
        self.table = PrefixTable(self.ids, lambda a, b: scores.get(a + b))
        self.id_text = [str(self.ids[name]) for name in self.table.names]
        self.id_surface = {str(i): p for p, i in self.ids.items()}
        held = set("".join(self.ids))
        if any(SPACE in p.lstrip(SPACE) or (p[0] == SPACE != p[1:2] and SPACE in p[1:]) for p in self.ids):
            raise ValueError("a piece crosses from a character to a space: this vocabulary can't be cut there")
        alone = "".join(c for c in "\n\t\r" if c not in held)  # no piece has them, so nothing merges across
        self.chunks = re.compile(rf"{SPACE}*[^{SPACE}{re.escape(alone)}]+|{SPACE}+" + (f"|[{re.escape(alone)}]" if alone else ""))

    def __missing__(self, chunk: str) -> tuple[str, str]:
        numbers = self.table.numbers(chunk)
        if min(numbers) >= 0:
            ids = [self.id_text[t] for t in numbers]
            surface = "".join([self.id_surface[i] for i in ids])
        else:
            plain: list[int] = []
            for t in numbers:
                plain += [int(self.id_text[t])] if t >= 0 else [self.byte_ids[b] for b in chr(~t).encode()]
            ids, surface = list(map(str, plain)), self._surface(plain)
        made = " ".join(ids), chunk if surface == chunk else surface
        if len(chunk) <= 64:
            if len(self) >= MEMO:
                self.clear()
            self[chunk] = made
        return made

    def _surface(self, ids: list[int]) -> str:
        """What these ids stand for, spaces still as U+2581; runs of byte ids are read as UTF-8."""
        out, run = [], bytearray()
        for i in ids:
            if i in self.bytes_of:
                run.append(self.bytes_of[i])
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run.clear()
            out.append(self.surfaces[i])
        if run:
            out.append(run.decode("utf-8", "replace"))
        return "".join(out)

    def _made(self, text: str) -> list[tuple[str, str]]:
        return list(map(self.__getitem__, self.chunks.findall(SPACE + text.replace(" ", SPACE)))) if text else []

    def encode(self, text: str) -> str:
        """Ids, the end id last, joined by spaces."""
        return self._joined(self._made(text))

    def _joined(self, made: list[tuple[str, str]]) -> str:
        return " ".join([*[m[0] for m in made], str(self.end)])

    def both(self, text: str) -> tuple[str, str]:
        """The ids joined by spaces, and the text that they decode to."""
        made = self._made(text)
        return self._joined(made), self._text("".join([m[1] for m in made]))

    @staticmethod
    def _text(surface: str) -> str:
        return surface.removeprefix(SPACE).replace(SPACE, " ")

    def decode(self, ids: list[int]) -> str:
        return self._text(self._surface([i for i in ids if i in self.surfaces or i in self.bytes_of]))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encoded(docs: DataFrame, model: str | None = None, key: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256; with ``whole`` the ids (array<int>) and the decoded text too."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        c = codec(model or public_tokenizers.path("piece_bpe_32k.model"))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in batches:
            rows = []
            for key_, t in zip(batch["key"], batch["text"], strict=True):
                a, b = c.both(t if isinstance(t, str) else "")
                rows.append((key_, a.count(" ") + 1, sha(a), sha(b), *(([int(x) for x in a.split(" ")], b) if whole else ())))
            yield pd.DataFrame(rows, columns=["key", "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if whole else [])])

    source = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    more = ", ids array<int>, decoded string" if whole else ""
    out = source.mapInPandas(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
    return out.withColumnRenamed("key", key)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(table(spark, sf_dir, "documents"))
