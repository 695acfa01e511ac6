"""Conversation repair, token files and whitening, each against a plain version."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from changeloom.llm import repair, token_files, whitening

SF = "/root/testdata/sf0.001"
CONV = "conv_id long, turn long, role string, text string"

# -- conversation repair -----------------------------------------------------------------------------------------------------


def plain_best(turns):
    """Cheapest edits, first in ASCII order, by trying all ways turn by turn; turns: (initial, must go, cut)."""
    to = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    states = {"": (0, "")}

    def offer(out, state, cost, audit):
        if state not in out or (cost, audit) < out[state]:
            out[state] = (cost, audit)

    def inserted(states):
        out = dict(states)
        for _ in range(3):
            for state, (cost, audit) in list(out.items()):
                for x in "ua":
                    if (state, x) in to:
                        offer(out, to[state, x], cost + 3, audit + "I")
        return out

    for initial, gone, cut in turns:
        out = {}
        for state, (cost, audit) in inserted(states).items():
            offer(out, state, cost + 4, audit + "D")
            if not gone:
                if (state, initial) in to:
                    offer(out, to[state, initial], cost + 3 * cut, audit + "K")
                for x in "ua":
                    if (state, x) in to:
                        offer(out, to[state, x], cost + 3 + 3 * cut, audit + "R")
        states = out
    return min(v for s, v in inserted(states).items() if s in ("", "a"))


def plain_repair(rows):
    """All of the query's columns, written out."""
    out = {conv: dict(gaps=0, blank=0, duplicate=0, truncated=0, illegal=0, cost=0, audit="", sha=hashlib.sha256(b"").hexdigest()) for conv, *_ in rows}
    by = {}
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        by.setdefault(conv, []).extend([(turn, role, text)] * (2 if kind == 3 else 1))
    for conv, turns in by.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        numbers = {t for t, _, _ in turns if t is not None}
        o, seen, found = out[conv], set(), []
        o["gaps"] = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        for _, role, text in turns:
            shown = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                o[fault] += 1
            found.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        o["illegal"] = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        o["cost"], o["audit"] = plain_best(found)
        lines, state, at = [], "", 0
        for edit in o["audit"]:
            must = "assistant" if state == "u" else "user"
            if edit == "I":
                lines.append(must + ":")
                state = must[0]
                continue
            role, text = turns[at][1:]
            at += 1
            if edit != "D":
                role = must if edit == "R" else role
                lines.append(f"{role}:{text}")
                state = role[0]
        o["sha"] = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return {(conv, *o.values()) for conv, o in out.items()}


def repaired(spark, rows, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame(rows, CONV).withColumn("place", F.lit(1)).withColumn("copies", F.lit("x")).repartition(3).write.parquet(f"{folder}/conversations.parquet")
    return {tuple(r) for r in repair.op11_conversation_repair(spark, folder).collect()}


@pytest.mark.parametrize("seed", range(40))
def test_search_is_the_cheapest_and_first(seed):
    rng = random.Random(seed)
    turns = [(rng.choice("suaut ?"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randrange(14))]
    turns = [(i, g, c and not g) for i, g, c in turns]
    assert repair.search([(*t, 0) for t in turns], repair.START) == plain_best(turns)


def test_search_of_repeated_turns():
    """Copies of a turn are further turns that must go."""
    rng = random.Random(2)
    for _ in range(50):
        turns = [(rng.choice("sua"), rng.random() < 0.2, False, rng.randrange(3)) for _ in range(6)]
        spelt = [x for i, g, c, more in turns for x in [(i, g, c)] + [(i, True, False)] * more]
        assert repair.search(turns, repair.START) == plain_best(spelt)


@pytest.mark.parametrize("piece", [2, 5, 48])
def test_repair_against_all_ways(spark, tmp_path, monkeypatch, piece):
    monkeypatch.setattr(repair, "PIECE", piece)
    rng = random.Random(piece)
    texts = ["Fine.", "No end", "", " \t", "Why?", "A! ", None, "ü…", "One. Two."]
    rows = [(c if c else None, rng.choice([None, *range(12)]) if c % 5 == 0 else t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(texts) if rng.random() < 0.4 else f"Turn {c} {t}.") for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(77, t, ("user", "assistant")[t % 2], f"Long {t}.") for t in range(150)] + [(78, 1, "user", "same.")] * 9 + [(2**60 + 1, 0, "user", "Big id.")]
    assert repaired(spark, rows, tmp_path) == plain_repair(rows)


def test_repair_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {tuple(r) for r in repair.op11_conversation_repair(spark, SF).collect()} == plain_repair(rows)


def test_sql_of_repair():
    """The query's SQL against the plain version, on awkward rows."""
    import duckdb

    rng = random.Random(3)
    texts = ["Fine.", "No end", "", " \t", "Why?", "A! ", None, "ü…", "One. Two."]
    rows = [(c if c else None, rng.choice([None, *range(12)]) if c % 5 == 0 else t, rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice(texts) if rng.random() < 0.4 else f"Turn {c} {t}.") for c in range(60) for t in range(rng.randrange(1, 9))]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations(conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    assert set(con.execute(repair.ORACLE).fetchall()) == plain_repair(rows)


def test_repair_empty(spark, tmp_path):
    assert repaired(spark, [], tmp_path) == set()


# -- token files -------------------------------------------------------------------------------------------------------------

ODD = [(5, "a., b. x.y. … .a"), (None, None), (3, ""), (3, "same words"), (3, "same words"), (1, "\x01 odd \x01x"), (9, "<|endoftext|>x <|startoftext|> İΑΣ \x85y　z"), (7, "word " * 30_000), (8, "x" * 50_000), (None, "no id"), (-4, "negative id")]


@pytest.fixture(scope="module")
def odd_docs(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("ids", F.lit("x")).withColumn("file", F.lit(1)).withColumn("start", F.lit(2))


def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return lambda text: [*made.encode(text or "", add_special_tokens=False).ids, token_files.END]


def test_token_files_against_the_library(spark, odd_docs, tmp_path, monkeypatch):
    ids = library()
    folder = str(tmp_path / "files")
    token_files.write(odd_docs, folder, files=3)
    rows = token_files.checksums(spark, folder).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter((d, len(ids(t)), zlib.crc32(np.array(ids(t), "<u4").tobytes())) for d, t in ODD)
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    assert Counter((r.doc_id, r.start, r.n_tokens) for r in token_files.placed(spark, folder).collect()) == Counter((r.doc_id, r.start, r.n_tokens) for r in rows)
    # a stretch of the stream that begins and ends inside documents
    stream = [x for file in sorted((tmp_path / "files").glob("part-*.parquet")) for ids_of in pq.read_table(file)["ids"].to_pylist() for x in ids_of]
    parts = token_files.tokens_between(spark, folder, 2, at - 3).orderBy("start").collect()
    assert [x for r in parts for x in r.ids] == stream[2 : at - 3] and parts[0].start == 2
    assert {r.doc_id for r in token_files.read(spark, folder, ("doc_id",), 3, 7).collect()} == {3, 5, 7}


def test_token_files_of_the_table(spark):
    ids = library()
    want = {r.doc_id: ids(r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = token_files.op12_token_files(spark, SF).collect()
    at = 0
    for r in sorted(rows, key=lambda r: r.doc_id):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(want[r.doc_id]), zlib.crc32(np.array(want[r.doc_id], "<u4").tobytes()))
        at += r.n_tokens
    assert len(rows) == len(want)


def test_layout_of_token_files(spark, tmp_path):
    """Encodings, several row groups, statistics of doc_id and page indexes; reads of counts leave the ids alone."""
    folder = str(tmp_path / "files")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    token_files.write(docs, folder, files=1, group_bytes=64 << 10, page_bytes=4 << 10, dictionary_bytes=512)
    meta = pq.ParquetFile(next((tmp_path / "files").glob("part-*.parquet"))).metadata
    groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
    named = [{g.column(i).path_in_schema.split(".")[0]: g.column(i) for i in range(g.num_columns)} for g in groups]
    assert len(groups) > 1 and all(g["doc_id"].statistics.has_min_max and g["doc_id"].has_column_index and g["ids"].has_offset_index for g in named)
    assert all(a["doc_id"].statistics.max <= b["doc_id"].statistics.min for a, b in zip(named, named[1:]))
    used = lambda of: {e for g in of for e in g["ids"].encodings}
    assert "DELTA_BINARY_PACKED" in used(named)
    token_files.write(docs, str(tmp_path / "wide"), files=1)
    meta = pq.ParquetFile(next((tmp_path / "wide").glob("part-*.parquet"))).metadata.row_group(0)
    assert "RLE_DICTIONARY" in meta.column(2).encodings and meta.column(2).path_in_schema.startswith("ids")
    plan = token_files.read(spark, folder, ("doc_id", "n_tokens"), 10, 20)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in plan and "GreaterThanOrEqual(doc_id,10)" in plan


def test_token_files_empty(spark, odd_docs, tmp_path):
    token_files.write(odd_docs.limit(0), str(tmp_path / "none"))
    assert token_files.checksums(spark, str(tmp_path / "none")).count() == 0


def test_memo_is_bounded(monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(token_files, "MEMO", 50)
    ids, made = library(), token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(3)
    for _ in range(60):
        text = " ".join(rng.choice(["Ab,", "cd.", "x" * 60, "é", "1,2", "don't."]) + "abcdefg"[: rng.randrange(8)] * rng.randrange(3) + rng.choice(["", ".", ".,"]) for _ in range(40))
        assert [np.frombuffer(x, np.int32).tolist() for x in made.encode([text, "", text[:30]])] == [ids(text)[:-1], [], ids(text[:30])[:-1]] and len(made.memo) <= 50 + 240


def test_chunks_are_looked_up_once():
    """The memo is asked for each distinct chunk of some texts, without the symbols at its end, and not for every place where one stands."""
    import public_tokenizers

    class Counted(dict):
        asked = 0

        def get(self, *a):
            Counted.asked += 1
            return super().get(*a)

    ids, made = library(), token_files.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    made.memo = Counted()
    texts = ["Word, word. été### 1,2. " * 500, "", " \t", "word!? ...", "\x1c Word.\x1d word\x85word.\xa0 it's, <|endoftext|>. Word,", "word\x00. e\u0301. \u01c4. ŁÓDŹ, \u0130. 中文. x_, a'. "]
    assert [np.frombuffer(x, np.int32).tolist() for x in made.encode(texts)] == [ids(t)[:-1] for t in texts]
    assert made.lists(texts, token_files.END).to_pylist() == [ids(t) for t in texts]
    assert Counted.asked < 100


# -- whitening ---------------------------------------------------------------------------------------------------------------


def plain_whitening(rows, k=8):
    x = [(i, [int(np.floor(1024 * c)) + 100000 for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    n, d = len(x), len(x[0][1])
    sums = [sum(v[j] for _, v in x) for j in range(d)]
    centred = np.array([[v[j] - sums[j] / n for j in range(d)] for _, v in x])
    cov = centred.T @ centred / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    far = [sum((n * v[j] - sums[j]) ** 2 for j in range(d)) for _, v in x]
    return [i for i, _ in x], n, far, centred @ q / np.sqrt(e), e / np.trace(cov)


def check_whitening(got, rows, k=8):
    ids, n, far, white, explained = plain_whitening(rows, k)
    k = white.shape[1]
    assert len(got) == n * k
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    signs = np.sign([sum(by[i][c + 1][0].whitened * white[p, c] for p, i in enumerate(ids)) for c in range(k)])
    for p, i in enumerate(ids):
        for c in range(k):
            r = by[i][c + 1][0]
            assert r.n == n and r.deviation == far[p] and abs(r.whitened * signs[c] - white[p, c]) < 1e-6 and abs(r.explained / explained[c] - 1) < 1e-9 and r.identity_error < 1e-6


def test_whitening_of_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check_whitening(whitening.op13_whitening(spark, SF).collect(), rows)


def test_whitening_awkward(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=12) * np.arange(1, 13)).tolist()) for i in range(60)]
    odd = [(100, None), (101, [1.0] * 11), (102, [None] + [1.0] * 11), (103, [float("nan")] * 12), (104, [float("inf")] + [0.0] * 11), (105, []), (106, [1e300] * 12)]
    kept = rows + [(None, rows[0][1]), (rows[3][0], rows[5][1])]
    df = spark.createDataFrame(kept + odd, "vec_id long, embedding array<double>").withColumn("component", F.lit("x")).withColumn("n", F.lit(1)).repartition(3)
    got = whitening.whitened(df).collect()
    assert Counter(r.vec_id for r in got) == Counter(i for i, _ in kept for _ in range(8)) and {r.n for r in got} == {62} and all(r.identity_error < 1e-9 for r in got)
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == Counter(zip([i for i, _ in kept], plain_whitening(kept)[2]))
    assert whitening.whitened(df.limit(0)).count() == 0 and whitening.whitened(df.where("vec_id = 100")).count() == 0
    assert whitening.whitened(df.limit(0)).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_whitening_without_variance(spark):
    """Three vectors span two components; alike ones none."""
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 9.0]), (2, [2.0, 1.0, 0.0, 9.0]), (3, [5.0, 5.0, 1.0, 9.0])], "vec_id long, embedding array<float>")
    got = whitening.whitened(df).collect()
    assert {r.component for r in got} == {1, 2, 3, 4} and all((r.whitened == 0) == (r.component > 2) for r in got) and all(r.identity_error == pytest.approx(1) for r in got)
    alike = whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")).collect()
    assert {(r.whitened, r.explained, r.deviation, r.identity_error) for r in alike} == {(0.0, 0.0, 0, 1.0)}


@pytest.mark.parametrize("width", [1, 5, 64, 300])
def test_eigenpairs(width):
    """Residuals at double precision, eigenvalues that lie close included."""
    rng = np.random.default_rng(width)
    x = rng.normal(size=(2000, width)) * np.sort(rng.choice([1, 1.0001, 3, 3.000001, 7], width)) * 300
    v = (x - x.mean(0)).T @ (x - x.mean(0)) / len(x)
    values, q = whitening.eigenpairs(v, width, 8)
    assert np.abs(values / np.linalg.eigvalsh(v)[::-1][:8] - 1).max() < 1e-12
    assert np.linalg.norm(v @ q - q * values, axis=0).max() < 1e-12 * values[0] and np.abs(q.T @ q - np.eye(len(values))).max() < 1e-12


def test_minres():
    rng = np.random.default_rng(1)
    a = rng.normal(size=(20, 20))
    a, b = a + a.T, rng.normal(size=(20, 3))
    assert np.abs(whitening.minres(lambda t: a @ t, b, 60, 1e-12) - np.linalg.solve(a, b)).max() < 1e-8


def test_deviations_beyond_a_long():
    x = np.array([[100_000, 2**40], [100_000, 0]])
    sums = np.array([200_000, 2**40], dtype=object)
    assert whitening.deviations(x, 2, sums) == [None, None] and whitening.deviations(np.array([[3, 5], [1, 1]]), 2, np.array([4, 6], dtype=object)) == [20, 20]
