"""N-gram Jaccard join by universe partition and pigeonhole, exact.

Sizes fall into bands. For a band, hashing deals the universe of shingles to segments; a pair with the smaller set in the band, at or above the threshold,
differs in at most H shingles. Each segment has an allocation: 1 (it matches when both sets hold the same part of it) or 2 (it also matches when the parts differ by
one shingle, found through the signatures of the part less each of its shingles, the one-deletion neighbourhood). The allocations of a band add up to H + 1 + spare, chosen by a
cost model of signatures against chance matches; so the segments of a similar pair that match have allocations of more than ``spare`` together. A set smaller than its band's largest leaves out
what its own pairs can't need, its largest signatures; as these are the ends of one order, a pair loses the longer of two such ends and keeps more than ``spare``.

That spare is what lets costly signatures go. All signatures have one order: those of empty parts, then those that most sets share, then the others; each set drops
its first ones as far as their allocations stay within the spare. (Take the last common signature of a pair in this order. Were it dropped, one set had dropped all common ones,
which together exceed the spare.) Empty segments go before anything is written, passages that many documents share after all signatures have been counted; no pair is lost.

Equal texts are signed once. Sets that hold the same shingles are one class. Within each remaining list of classes, all are first compared with the smallest one; components of the links found
join most of a group of copies at a cost linear in its size. Then each list with several components compares another of its members with the rest, STARS times.
Of lists that still hold several components, short ones are compared pair by pair. Long ones come from groups of near misses; their classes are dealt to blocks, and
blocks of a group are compared in numpy, two at a time, but for those that lie in the group's largest component; only links leave the tasks. Comparing is exact, on the shingles of the
texts themselves as 64-bit hashes (shingles.py).

That settles the components. Both ends of a link lie in one component, so the number of links of a class is counted by comparing all classes of its component, each pair once: small components are
packed together, large ones dealt to blocks and compared two blocks at a time. Counts per class leave the tasks, no pairs; they don't depend on which pairs were compared before.

Cases: null text or one without words has an empty set, is in no class and its own component; with fewer words than a shingle the whole sequence is one; null
ids are kept, and a component's id is the smallest id that isn't null; equal ids with different texts are separate rows; ties and repeated rows fall together; an empty table gives an empty result; extra
columns don't take part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeloom.llm.common import discard, spread_join, stored, table
from changeloom.llm.components import components, joined_by
from changeloom.llm.shingles import mix, portions, shingle_sets

WIDTH, THRESHOLD = 4, (85, 100)
#: Spare allocations as a part of those needed: more make more signatures and fewer near misses to compare, which pays where the threshold is low.
SPARE = 0.12
#: Signatures that one chance match is worth.
CHANCE = 10
#: Bits of a signature. Chance agreements only cost a comparison; at 10**13 signatures they are 2 in 100.
KEPT_BITS = (1 << 48) - 1
#: Bytes of text that are signed or compared together, for the memory of a task; one longer text is taken alone.
BYTES = 1 << 21
#: Partners of a text that one task compares with it.
LOT = 64
#: Turns in which lists compare one member with all others.
STARS = 2
#: Lists with more classes are compared in blocks, shorter ones pair by pair.
LONG = 32
#: Shingles, and for each class CLASS more, that a block holds.
BLOCK, CLASS = 1 << 19, 200


@lru_cache(maxsize=8)
def _bands(threshold: tuple[int, int], upto: int, share: float = SPARE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lowest and highest size of each band, and its exact segments, deletion segments and spare (all 0 where no two different sets can be similar)."""
    num, den = threshold
    rows, low = [], 1
    while low <= upto:
        high = max(low, low * den // num * den // num)
        h = (high + high * den // num) * (den - num) // (den + num)
        if h:
            spare = max(1, math.ceil(share * (h + 1)))
            need = h + 1 + spare
            cost = lambda two, need=need, high=high: (one := max(0, need - 2 * two)) + two * (1 + (g := high / (one + two))) + CHANCE * one * math.exp(-g)
            two = min(range(min(need // 2 + need % 2, 400) + 1), key=cost)
            rows.append((low, high, max(0, need - 2 * two), two, spare))
        else:
            rows.append((low, high, 0, 0, 0))
        low = high + 1
    return tuple(np.array(x, np.int64) for x in zip(*rows, strict=True))


def _signatures(tokens: np.ndarray, doc: np.ndarray, band: np.ndarray, ones: np.ndarray, twos: np.ndarray, fewer: np.ndarray, spare: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of all sets for their bands, ordered by set, how many each has, and what is left of its spare.

    doc: each token's set; band: each set's, -1 for none; fewer: how far below the band's the differences of a set's own pairs stay, the allocations that it needn't give: its largest signatures go.
    spare: each set's. Signatures of empty parts take of it first; nothing is left of it where one of them has to stay.
    """
    n_docs = len(band)
    m = np.where(band >= 0, (ones + twos)[band], 0)
    base = np.concatenate(([0], np.cumsum(m)))
    live = m[doc] > 0
    tokens, doc = tokens[live], doc[live]
    salt = mix(band.astype(np.uint64) + np.uint64(77))
    segment = (mix(tokens ^ salt[doc]) % m[doc].astype(np.uint64)).astype(np.int64)
    at = base[doc] + segment
    spread = mix(tokens + np.uint64(0x5851F42D4C957F2D))
    size = int(base[-1])
    low = np.bincount(at, weights=(spread & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=size).astype(np.uint64)
    high = np.bincount(at, weights=(spread >> np.uint64(32)).astype(np.float64), minlength=size)
    high = np.mod(high, 2.0**32).astype(np.uint64)
    sums = low + (high << np.uint64(32))
    owner = np.repeat(np.arange(n_docs), m)
    number = np.arange(size) - base[owner]
    key = mix(salt[owner] + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    two = number >= ones[band[owner]]
    flag = lambda s, second: (s & ~np.uint64(1)) | second.astype(np.uint64)  # noqa: E731  the lowest bit tells allocation 2
    full = flag(mix(sums ^ key), two)
    held = np.bincount(at, minlength=size)
    less = two[at]
    gone = flag(mix((sums[at[less]] - spread[less]) ^ key[at[less]]), np.ones(int(less.sum()), bool))
    values, owners = np.concatenate((full, gone)), np.concatenate((owner, doc[less]))
    empty = np.concatenate((held == 0, held[at[less]] == 1))
    values &= np.uint64(KEPT_BITS)
    order = np.lexsort((values, owners))
    values, owners, empty = values[order], owners[order], empty[order]
    weights = np.concatenate(([0], np.cumsum(1 + (values & np.uint64(1)).astype(np.int64))))
    ends = np.searchsorted(owners, np.arange(n_docs), side="right")
    stays = weights[ends[owners]] - weights[:-1] > fewer[owners]
    values, owners, empty = values[stays], owners[stays], empty[stays]
    so_far = np.cumsum(np.where(empty, 1 + (values & np.uint64(1)).astype(np.int64), 0))
    bounds = np.searchsorted(owners, np.arange(n_docs + 1))
    so_far = np.concatenate(([0], so_far))
    of_empty = so_far[bounds[1:]] - so_far[bounds[:-1]]
    stays = ~(empty & (so_far[1:] - so_far[bounds[owners]] <= spare[owners]))
    return values[stays], np.bincount(owners[stays], minlength=n_docs), np.where(of_empty <= spare, spare - of_empty, 0)


def signed(texts: DataFrame, width: int, threshold: tuple[int, int], spare_share: float = SPARE) -> DataFrame:
    """texts (t, text: not null) -> rid, t, n, two hashes of the set, its signatures for its own band and for the one below, and what is left of both spares."""
    num, den = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a, b in portions(pc.binary_length(whole.column(1)).to_pylist(), BYTES):
                part = whole.slice(a, b - a)
                yield one(part.column(0), [t.encode() for t in part.column(1).to_pylist()])

    def one(t: pa.Array, raw: list[bytes]) -> pa.RecordBatch:
        tokens, starts = shingle_sets(raw, width)
        n = np.diff(starts)
        doc = np.repeat(np.arange(len(n)), n)
        upto = 1 << max(10, int(n.max(initial=1)).bit_length())
        low, high, ones, twos, spare = _bands(threshold, upto, spare_share)
        most = ones + 2 * twos - 1 - spare  # differences that the band allows for
        own = np.searchsorted(low, n, side="right") - 1  # -1 for empty sets
        own = np.where(n > 0, own, -1)
        below = np.where((own > 0) & (-(-n * num // den) <= high[own - 1]), own - 1, -1)
        out = [t, pa.array(n), *_hashes_of(tokens, starts)]
        for band, partner in ((own, n * den // num), (below, np.minimum(n, high[below]))):
            fewer = np.maximum(most[band] - (n + partner) * (den - num) // (den + num), 0)
            values, counts, left = _signatures(tokens, doc, band, ones, twos, fewer, np.where(band >= 0, spare[band], 0))
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            out += [pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64))), pa.array(left.astype(np.int32))]
        return pa.RecordBatch.from_arrays(out, names=["t", "n", "d1", "d2", "own", "own_spare", "below", "below_spare"])

    return texts.select("t", "text").mapInArrow(run, "t string, n long, d1 long, d2 long, own array<long>, own_spare int, below array<long>, below_spare int").withColumn("rid", F.monotonically_increasing_id())


def _hashes_of(tokens: np.ndarray, starts: np.ndarray) -> list[pa.Array]:
    """Two hashes of each set."""
    return [pa.array(_sums(mix(tokens + np.uint64(k)), starts).view(np.int64)) for k in (1, 2)]


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
    return sums[starts[1:]] - sums[starts[:-1]]


def _similar(pairs: DataFrame, texts: DataFrame, width: int, threshold: tuple[int, int]) -> DataFrame:
    """Of distinct pairs (a, b) those whose sets are at or above the threshold, compared shingle by shingle.

    The partners of one a are dealt to tasks in lots of about LOT; its text goes once to each lot, ahead of theirs, and a task holds one such set at a time.
    """
    num, den = threshold

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.zeros(0, np.uint64)  # the set of the text that those after it are compared with
        for whole in batches:
            for low, high in portions(pc.binary_length(whole.column(2)).to_pylist(), BYTES):
                part = whole.slice(low, high - low)
                tokens, starts = shingle_sets([t.encode() for t in part.column(2).to_pylist()], width)
                keep = []
                for i, partner in enumerate(part.column(1).to_pylist()):
                    y = tokens[starts[i] : starts[i + 1]]
                    if partner is None:
                        first = y.copy()
                        continue
                    common = int(np.isin(y, first, assume_unique=True).sum()) if len(first) * den >= len(y) * num and len(y) * den >= len(first) * num else 0
                    if den * common >= num * (len(first) + len(y) - common):
                        keep.append(i)
                chosen = pa.array(keep, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(chosen), part.column(1).take(chosen)], names=["a", "b"])

    lots = pairs.groupBy("a").agg(F.ceil(F.count("*") / LOT).alias("lots"))
    by_rep = lambda x: texts.select(F.col("rep").alias(x), "text")
    partners = pairs.join(lots, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("lots")).alias("lot")).join(by_rep("b"), "b").select("a", "b", "text", "lot")
    heads = lots.join(by_rep("a"), "a").select("a", F.lit(None).cast("long").alias("b"), "text", F.explode(F.sequence(F.lit(0).cast("long"), F.col("lots") - 1)).alias("lot"))
    dealt = partners.unionByName(heads).repartition("a", "lot").sortWithinPartitions("a", "lot", F.col("b").asc_nulls_first())
    return dealt.select("a", "b", "text").mapInArrow(run, "a long, b long")


def join(docs: DataFrame, width: int = WIDTH, threshold: tuple[int, int] = THRESHOLD, key: str = "doc_id", text: str = "text", spare_share: float = SPARE, with_links: bool = True) -> DataFrame:
    """Per row of docs: key, n_shingles, component_id, and with_links the number of links to other classes, all of them."""
    spark = docs.sparkSession
    address = F.substring(F.sha2(F.col(text).cast("binary"), 256), 1, 32)  # of the content: 128 bits
    contents = docs.where(F.col(text).isNotNull()).select(address.alias("t"), F.col(text).alias("text")).dropDuplicates(["t"])
    sets = stored(signed(contents, width, threshold, spare_share), "sets")
    filled = sets.where("n > 0")
    classes = filled.groupBy("d1", "d2").agg(F.min("rid").alias("rep"))
    members = stored(filled.select("rid", "t", "n", "d1", "d2", "own_spare", "below_spare").join(classes, ["d1", "d2"]), "members")  # a row a text
    same = Window.partitionBy("sig")
    shared = stored(_shared(filled), "shared")
    discard(spark, sets)  # all signatures are the largest table here
    kept = stored(_lists(shared, members).withColumn("first", F.min("rep").over(same)), "lists")
    discard(spark, shared)

    # texts of the classes that occur there, one each
    wanted = kept.select("rep").distinct().join(members.where("rid = rep").select("rep", "t"), "rep")
    texts = stored(contents.join(wanted, "t").select("rep", "text"), "texts")
    discard(spark)

    compare = lambda pairs: stored(_similar(pairs.distinct(), texts, width, threshold), "links")
    found = components(compare(kept.where("first <> rep").select(F.col("first").alias("a"), F.col("rep").alias("b"))))
    sizes = members.where("rid = rep").select("rep", "n")
    for turn in range(STARS + 1):
        mixed = kept = _mixed(kept, found)  # a list that lies in one component stays so
        if mixed.isEmpty():
            break
        if turn < STARS:
            # each list takes another member, other lists' members differing, and compares it with those that lie in other components
            centre = F.min(F.struct(F.xxhash64("rep", "sig", F.lit(turn)).alias("h"), F.col("rep").alias("rep"), F.col("component").alias("component"))).over(same)
            star = mixed.withColumn("centre", centre).where(F.col("centre.component") != F.col("component"))
            links = compare(star.select(F.col("centre.rep").alias("a"), F.col("rep").alias("b")))
        else:
            sized = mixed.withColumn("n_classes", F.count("*").over(same))
            x, y = (sized.where(F.col("n_classes") <= LONG).alias(name) for name in "xy")
            left = x.join(y, F.col("x.sig") == F.col("y.sig")).where((F.col("x.rep") < F.col("y.rep")) & (F.col("x.component") != F.col("y.component")))
            links = compare(left.select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")))
            links = links.union(stored(_in_blocks(sized.where(F.col("n_classes") > LONG), sizes, texts, width, threshold), "links"))
        found = joined_by(found, links)

    # from classes to texts to rows; what many rows share is joined by spread_join
    rows = docs.select(F.col(key).alias("key"), address.alias("t"))
    per_text = members.select("t", "n", "rep").join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    per_text = stored(per_text.join(rows.groupBy("t").agg(F.min("key").alias("least")), "t"), "components")
    least = per_text.groupBy("component").agg(F.min("least").alias("component_id"))
    per_text = spread_join(per_text.drop("least"), least, "component")
    if with_links:
        per_text = spread_join(per_text, stored(_degrees(found, sizes, texts, width, threshold), "degrees"), "rep")
    full = spread_join(rows, stored(per_text.drop("rep", "component"), "components"), "t")
    no_set = F.col("n").isNull()
    columns = [F.col("key").alias(key), F.coalesce("n", F.lit(0).cast("long")).alias("n_shingles"), F.when(no_set, F.col("key")).otherwise(F.col("component_id")).alias("component_id")]
    return full.select(*columns, *([F.coalesce("links", F.lit(0).cast("long")).alias("links")] if with_links else []))


def _degrees(found: DataFrame, sizes: DataFrame, texts: DataFrame, width: int, threshold: tuple[int, int]) -> DataFrame:
    """rep, links: the number of classes at or above the threshold with it, for those that have any. found: node, component; sizes: rep, n."""
    num, den = threshold
    placed = found.withColumnRenamed("node", "rep").join(sizes, "rep").withColumn("weight", F.col("n") + CLASS)
    per_part = stored(placed.groupBy("component").agg(F.ceil(F.sum("weight") / BLOCK).alias("n_blocks"), F.sum("weight").alias("weight")), "parts")
    packs = math.ceil((per_part.where("n_blocks = 1").agg(F.sum("weight")).first()[0] or 1) / BLOCK)
    alone = F.col("n_blocks") > 1
    placed = placed.drop("weight").join(per_part.drop("weight"), "component")
    placed = placed.withColumn("near", F.when(alone, F.col("component")).otherwise(-1 - F.pmod(F.xxhash64("component"), F.lit(packs))))  # components are not negative
    placed = placed.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("n_blocks"))).join(texts, "rep")
    # a block meets every block of its component, itself included
    dealt = _met(placed, F.col("n_blocks"))

    def count(group: pd.DataFrame) -> pd.DataFrame:
        first, second = _sides(group)
        if first.empty or second.empty:
            return pd.DataFrame({"rep": [], "links": []}, dtype="int64")
        reps_y, in_x, in_y = second["rep"].to_numpy(), first["component"].to_numpy(), second["component"].to_numpy()
        reps_x, links_x, links_y = first["rep"].to_numpy(), np.zeros(len(first), np.int64), np.zeros(len(second), np.int64)
        for i, linked in _against(first["text"], second["text"], width, num, den):
            linked &= (in_y == in_x[i]) & (reps_y != reps_x[i])
            links_x[i] = linked.sum()
            links_y += linked
        reps, links = (reps_x, links_x) if first is second else (np.concatenate((reps_x, reps_y)), np.concatenate((links_x, links_y)))
        return pd.DataFrame({"rep": reps[links > 0], "links": links[links > 0]})

    return dealt.groupBy("near", "p", "q").applyInPandas(count, "rep long, links long").groupBy("rep").agg(F.sum("links").alias("links"))


def _met(placed: DataFrame, others: Column) -> DataFrame:
    """placed (near, block, rep, component, text) once for each of the blocks from 0 to others - 1 that its block meets: near, the two blocks p <= q, and whether it is on the side of the second."""
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), others - 1)))
    return dealt.select("near", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), (F.col("block") > F.col("other")).alias("second"), "rep", "component", "text")


def _sides(group: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The two blocks of a group, or one twice."""
    group = group.sort_values("rep")
    return (group, group) if group["p"].iloc[0] == group["q"].iloc[0] else (group[~group["second"]], group[group["second"]])


def _against(first: pd.Series, second: pd.Series, width: int, num: int, den: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each text of the first side its number, and which of the second are at or above the threshold with it."""
    (x, at_x), (y, at_y) = (shingle_sets([t.encode() for t in side], width) for side in (first, second))
    # for each shingle of the second side, the numbers of the sets that hold it, one after the other
    order = np.argsort(y, kind="stable")
    holders = np.repeat(np.arange(len(second)), np.diff(at_y))[order]
    y = y[order]
    low, high = np.searchsorted(y, x, "left"), np.searchsorted(y, x, "right")
    n_x, n_y = np.diff(at_x), np.diff(at_y)
    for i in range(len(first)):
        a, n = low[at_x[i] : at_x[i + 1]], (high - low)[at_x[i] : at_x[i + 1]]
        places = np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        common = np.bincount(holders[places], minlength=len(second))
        yield i, den * common >= num * (n_x[i] + n_y - common)


def _in_blocks(long: DataFrame, sizes: DataFrame, texts: DataFrame, width: int, threshold: tuple[int, int]) -> DataFrame:
    """Links between classes of different components that share one of these lists (sig, rep, component). sizes: rep, n."""
    num, den = threshold
    near = components(long.withColumn("a", F.min("rep").over(Window.partitionBy("sig"))).select("a", F.col("rep").alias("b")))
    placed = long.select("rep", "component").distinct().join(near.select(F.col("node").alias("rep"), F.col("component").alias("near")), "rep").join(sizes, "rep").withColumn("weight", F.col("n") + CLASS)
    per_part = placed.groupBy("near", "component").agg(F.sum("weight").alias("weight"))
    main = per_part.groupBy("near").agg(F.max(F.struct("weight", "component")).alias("main"), F.sum("weight").alias("all"))
    blocks = lambda weight: F.ceil(weight / BLOCK)
    main = main.select("near", F.col("main.component").alias("main"), blocks(F.col("all") - F.col("main.weight")).alias("outer"), blocks(F.col("main.weight")).alias("inner"))
    # blocks of the largest component come after the others and don't meet one another
    inside = F.col("component") == F.col("main")
    placed = placed.join(main, "near").withColumn("block", F.when(inside, F.col("outer") + F.pmod(F.xxhash64("rep"), F.col("inner"))).otherwise(F.pmod(F.xxhash64("rep"), F.col("outer"))))
    dealt = _met(placed.join(texts, "rep"), F.when(inside, F.col("outer")).otherwise(F.col("outer") + F.col("inner")))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        first, second = _sides(group)
        if first.empty or second.empty:
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        reps_x, reps_y, in_x, in_y = first["rep"].to_numpy(), second["rep"].to_numpy(), first["component"].to_numpy(), second["component"].to_numpy()
        found = []
        for i, linked in _against(first["text"], second["text"], width, num, den):
            linked &= in_y != in_x[i]
            found += [(min(reps_x[i], r), max(reps_x[i], r)) for r in reps_y[linked]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("near", "p", "q").applyInPandas(compare, "a long, b long").distinct()


def _shared(sets: DataFrame) -> DataFrame:
    """sig, who (2 * rid, + 1 for the band below) of sets (rid, own, below): signatures of more than one row. Two sets of which neither has the band as its own needn't meet."""
    same = Window.partitionBy("sig")
    exploded = sets.select(F.explode("own").alias("sig"), (F.col("rid") * 2).alias("who")).union(sets.select(F.explode("below").alias("sig"), (F.col("rid") * 2 + 1).alias("who")))
    return exploded.withColumn("n_rows", F.count("*").over(same)).withColumn("n_own", F.count_if(F.col("who") % 2 == 0).over(same)).where("n_rows > 1 AND n_own > 0").select("sig", "who")


def _lists(shared: DataFrame, members: DataFrame) -> DataFrame:
    """sig, rep: signatures that two classes or more share, when each class has dropped its longest lists within its spare. members: rid, rep, own_spare, below_spare."""
    same = Window.partitionBy("sig")
    by_class = shared.withColumn("rid", F.floor(F.col("who") / 2)).join(members.select("rid", "rep", "own_spare", "below_spare"), "rid")
    lists = by_class.select("sig", "rep", (F.col("who") % 2).alias("below"), F.when(F.col("who") % 2 == 0, F.col("own_spare")).otherwise(F.col("below_spare")).alias("spare")).distinct()
    counted = lists.withColumn("n_classes", F.count("*").over(same)).where("n_classes > 1")
    longest = Window.partitionBy("rep", "below").orderBy(F.desc("n_classes"), "sig").rowsBetween(Window.unboundedPreceding, 0)
    kept = counted.withColumn("dropped", F.sum(1 + F.col("sig").bitwiseAND(1)).over(longest)).where("dropped > spare").select("sig", "rep").distinct()
    return kept.withColumn("n_classes", F.count("*").over(same)).where("n_classes > 1").select("sig", "rep")


def _mixed(lists: DataFrame, found: DataFrame) -> DataFrame:
    """sig, rep, component of the lists whose classes lie in different components."""
    same = Window.partitionBy("sig")
    placed = lists.select("sig", "rep").join(found.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    return stored(placed.withColumn("least", F.min("component").over(same)).withColumn("most", F.max("component").over(same)).where("least <> most").select("sig", "rep", "component"), "mixed")


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents").select("doc_id", "text"))
