"""Near-duplicates by MinHash bands and bottom-k sketches of word shingles, exactly verified.

Texts with equal shingle sets form a class and are handled once. A class is
posted in an inverted list for each of ``BANDS`` bands: its least values under
``ROWS`` hash functions each. Two sets of Jaccard similarity j share a band with
probability j ** ROWS, so that unlike texts seldom meet however many there are;
a pair at ``THRESHOLD`` shares none of them with 1.3 in ten million, above it, less.
Classes of ``SMALL`` shingles at most are posted, without any such loss, under the
n - ceil(0.8 n) + 1 rarest shingles instead, of which two similar sets share one by
the prefix-filter argument, whatever the order of rarity (it comes from a table
of fixed size that counts the shingles of short texts by hash bucket); those that may match a
larger class are posted both ways.

One hash function orders all shingles; a text's sketch is its K least values. If two
sets are similar by THRESHOLD, their sketches agree in at least ``AGREE`` of K values
(short of 1.4 pairs in a million at the threshold itself, one set inside the other;
above it, less). A sketch is kept as a bit table of ``SIGNATURE`` bits. The bits in
which two tables differ are at most the values that the sketches don't share, so pairs
with too many of them are dropped before their texts are read.

A list links its classes to its least class only. In a list of ``SHORT`` classes at
most, the others then meet across components, by their signatures. Where components
still differ in longer lists, their most frequent classes become centres, and each class of such a list
whose signature is like its centre's is compared with it. Classes near the centre
are then compared among one another, across components and in blocks, by their
few differences to it: their exact similarity follows from those. Pairs with a
class far from the centre are tried one by one: all that a list has across
components meet, but only by their signatures; those that remain are few. No list
is expanded within a component. A union-sketch estimate drops hopeless pairs, and
full sets decide on each link.

Defined cases: null, empty and blank texts have an empty set and no links; a
text with fewer words than a shingle is one shingle; repeated rows share a
class; a null id joins its text's component, whose id is the least non-null one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import words
from ledgerlake.llm.components import components, merged
from ledgerlake.llm.store import checkpointed, release, small_batches

K = 128
AGREE = 80
THRESHOLD = (4, 5)         # 0.8, as a fraction of integers
BANDS, ROWS = 40, 5        # of hash functions
SMALL = 32                 # shingles up to which a class is posted under the rarest
SMALL_CHARS = 1024         # of the texts that the rarity table counts; it only orders shingles
SHORT = 8                  # classes of a list that meet pair by pair
NEAR = 0.5                 # similarity to a centre from which differences to it are kept
BLOCK = 1024               # classes that are compared at once
BLOCK_BYTES = 4096         # of differences that count as one class more
BUCKETS = 1 << 17          # of the rarity table, whatever the corpus
SIGNATURE = 512            # bits of a sketch's table
LIKE = 144                 # differing bits from a centre up to which its texts are compared (unlike sketches: about 176)
BROADCAST_ROWS = 1_000_000  # ids (8 bytes each); beyond, a shuffle
STEP = 128                 # shingles hashed together
_random = np.random.default_rng(1)
FACTORS = (_random.integers(0, 1 << 32, BANDS * ROWS, np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]  # a hash function each
MIX = _random.integers(0, 1 << 63, ROWS, np.uint64) << np.uint64(1) | np.uint64(1)


def _digest(s: np.ndarray) -> int:
    """64 bits of a shingle set: two sums of differently mixed values."""
    a = np.add.reduce(words.mixed(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)))
    x = np.array([a + np.uint64(len(s)), np.bitwise_xor.reduce(s)], np.uint64)
    return int(words.mixed(x[:1] * np.uint64(31) + words.mixed(x[1:]))[0].astype(np.int64))


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _sets(batch: pa.RecordBatch, column: int, size: int):
    """(row, sorted shingle set) of a batch's texts."""
    for start, _, w in words.blocks(batch.column(column)):
        for k, s in enumerate(words.shingles(w, size)):
            yield start + k, s


def rarity(docs: DataFrame, text: str, size: int) -> np.ndarray:
    """Counts of the shingles of short texts by bucket: BUCKETS integers, summed in Spark."""
    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            held = [s for _, s in _sets(batch, 0, size) if len(s) <= SMALL]
            if held:
                total += np.bincount((np.concatenate(held) % np.uint64(BUCKETS)).astype(np.int64), minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    short = docs.select(text).where(F.length(text) <= SMALL_CHARS)
    rows = short.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros(BUCKETS, np.int64)
    table[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return table


def minima(s: np.ndarray) -> np.ndarray:
    """A set's least values under the hash functions."""
    h = (s >> np.uint64(31)).astype(np.uint32)
    least = np.full(len(FACTORS), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(h), STEP):
        np.minimum(least, (h[None, k:k + STEP] * FACTORS).min(1), out=least)
    return least


def keys(s: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The inverted lists that a shingle set is posted in."""
    n = len(s)
    if not n:
        return s
    num, den = THRESHOLD
    found = []
    if n <= SMALL:
        rare = np.lexsort((s, counts[(s % np.uint64(BUCKETS)).astype(np.int64)]))
        found.append(s[rare[:n - -(-n * num // den) + 1]])
    if n * den > SMALL * num:
        bands = (minima(s).reshape(BANDS, ROWS).astype(np.uint64) * MIX).sum(1, dtype=np.uint64)
        found.append(words.mixed(bands + words.mixed(np.arange(1, BANDS + 1, dtype=np.uint64))))
    return np.concatenate(found)


def signature(s: np.ndarray) -> np.ndarray:
    """The bit table of a set's sketch, as 64-bit integers."""
    table = np.zeros(SIGNATURE, np.uint8)
    table[(words.mixed(s[:K]) % np.uint64(SIGNATURE)).astype(np.int64)] = 1
    return np.packbits(table).view(np.int64)


def postings(docs: DataFrame, doc_id: str, text: str, size: int, counts: np.ndarray) -> DataFrame:
    """doc_id, n (set size), cls (class, null for an empty set), keys and bits (signature) of every row."""
    id_type = docs.schema[doc_id].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # fixed size

    def run(batches):
        for batch in batches:
            n, cls, found, bits = [], [], [], []
            for _, s in _sets(batch, 1, size):
                n.append(len(s))
                cls.append(_digest(s) if len(s) else None)
                found.append(_signed(keys(s, shared.value)))
                bits.append(signature(s))
            offsets = np.cumsum([0, *map(len, found)], dtype=np.int32)
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int32()), pa.array(cls, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(bits) + 1, dtype=np.int32) * (SIGNATURE // 64)),
                                          pa.array(np.concatenate(bits) if bits else np.zeros(0, np.int64)))],
                names=["doc_id", "n", "cls", "keys", "bits"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {id_type}, n int, cls long, keys array<long>, bits array<long>")


def similar(s: np.ndarray, t: np.ndarray) -> bool:
    """Whether two sorted sets reach THRESHOLD: estimated on the union's sketch, then confirmed on the whole sets."""
    num, den = THRESHOLD
    if min(len(s), len(t)) * den < max(len(s), len(t)) * num:
        return False
    if len(s) > K and len(t) > K:
        both = np.sort(np.concatenate((s[:K], t[:K])))
        twice = both[1:] == both[:-1]
        union = both[np.concatenate(([True], ~twice))]
        limit = union[min(K, len(union)) - 1]
        if np.count_nonzero(twice & (both[1:] <= limit)) < AGREE:
            return False
    both = np.sort(np.concatenate((s, t)), kind="stable")
    common = np.count_nonzero(both[1:] == both[:-1])
    return common * den >= (len(s) + len(t) - common) * num


def _texts(need: DataFrame, found: DataFrame, several: bool, docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """cls and one text of each class in ``need`` (cls); ``several``: an id may have several classes."""
    one = checkpointed(docs.sparkSession, found.join(need, "cls").groupBy("cls").agg(F.min("doc_id").alias("doc_id")))
    if one.count() <= BROADCAST_ROWS:
        one = F.broadcast(one)
    at = docs.select(F.col(doc_id).alias("d"), F.col(text).alias("text")).join(one, F.col("d").eqNullSafe(F.col("doc_id")))

    # An id that is not unique may have other texts; only the class's own counts.
    def own(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            cls = batch.column(0).to_pylist()
            for row, s in _sets(batch, 1, size):
                keep[row] = len(s) > 0 and _digest(s) == cls[row]
            yield batch.filter(pa.array(keep))

    sets = at.select("cls", "text")
    if several:
        sets = sets.mapInArrow(own, "cls long, text string")
    return sets.dropDuplicates(["cls"])


def _verified(pairs: DataFrame, found: DataFrame, several: bool, docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """The pairs (a, b) of classes that are similar by their full sets."""
    need = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = _texts(need, found, several, docs, doc_id, text, size)
    both = pairs.join(sets.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(sets.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                left = [s for _, s in _sets(part, 2, size)]
                right = [s for _, s in _sets(part, 3, size)]
                keep = pa.array([similar(s, t) for s, t in zip(left, right, strict=True)], pa.bool_())
                yield part.select([0, 1]).filter(keep)

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _possible(condition: str):
    """Pairs whose set sizes allow the similarity."""
    num, den = THRESHOLD
    return F.expr(f"{condition} AND least(n_a, n_b) * {den} >= greatest(n_a, n_b) * {num}")


def _differing(a: str, b: str) -> str:
    """In how many bits two signatures differ."""
    return "(" + " + ".join(f"bit_count({a}[{i}] ^ {b}[{i}])" for i in range(SIGNATURE // 64)) + ")"


def _alike(differing: str) -> str:
    """Whether sketches that differ in so many bits at least can agree as the threshold demands."""
    num, den = THRESHOLD
    return f"{differing} <= least(n_a, {K}) + least(n_b, {K}) - 2 * least({AGREE}, (greatest(n_a, n_b) * {num} + {den - 1}) div {den})"


def _hopeful(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) that their signatures allow."""
    side = lambda x: classes.select(F.col("cls").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in ("n", "bits")))
    return pairs.join(side("a"), "a").join(side("b"), "b").where(_alike(_differing("bits_a", "bits_b"))).select("a", "b")


def _shared(found: DataFrame) -> DataFrame:
    """v, cls, n, c (the list's least class), n_c, k (classes) of the lists that hold several; slim rows, shuffled by list once."""
    one = found.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.first("n").alias("n"), F.first("keys").alias("keys"))
    lists = one.select(F.explode("keys").alias("v"), "cls", "n").repartition("v")
    least = lists.groupBy("v").agg(F.min(F.struct("cls", "n")).alias("c"), F.count("*").alias("k")).where("k > 1")
    return lists.join(least, "v").select("v", "cls", "n", F.col("c.cls").alias("c"), F.col("c.n").alias("n_c"), "k")


def _star(lists: DataFrame) -> DataFrame:
    """Pairs of each list's least class with its other classes."""
    at = lists.where("cls <> c").select(F.col("c").alias("a"), F.col("cls").alias("b"), F.col("n_c").alias("n_a"), F.col("n").alias("n_b"))
    return at.where(_possible("true")).select("a", "b").distinct()


def _short_pairs(lists: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs across components of the classes of short lists, without the least ones: those are settled."""
    at = _relabelled(lists.where(f"k > 2 AND k <= {SHORT} AND cls <> c").select("v", "cls", "n"), labels)
    side = lambda x: at.select("v", *(F.col(c).alias(f"{c}_{x}") for c in ("cls", "n", "comp")))
    both = side("a").join(side("b"), "v").where(_possible("cls_a < cls_b AND comp_a <> comp_b"))
    return both.select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct()


def _open(lists: DataFrame, labels: DataFrame, *more: str) -> DataFrame:
    """v, cls, n, comp and ``more`` of the lists that hold classes of more than one component."""
    at = _relabelled(lists, labels)
    several = at.groupBy("v").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("v")
    return at.join(several, "v").select("v", "cls", "n", "comp", *more)


def _relabelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    at = rows.drop("comp").join(labels.select(F.col("node").alias("cls"), "component"), "cls", "left")
    return at.withColumn("comp", F.coalesce("component", "cls")).drop("component")


def _centred(lists: DataFrame) -> DataFrame:
    """``lists`` with c, each list's centre: its class that is in the most lists."""
    often = lists.groupBy("cls").agg(F.count("*").alias("often"))
    centre = lists.select("v", "cls").join(often, "cls").groupBy("v").agg(F.max(F.struct("often", "cls")).alias("c"))
    return lists.join(centre.select("v", F.col("c.cls").alias("c")), "v")


def _differences(members: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """Of every (c, cls): n_c, n, j (similarity to c) and, where j is at least NEAR, how cls differs from c:
    the bits of c's shingles that it lacks and the shingles that it has besides."""
    at = members.join(texts.select(F.col("cls").alias("c"), F.col("text").alias("text_c")), "c")
    at = at.join(texts.select("cls", "text"), "cls").select("c", "cls", "text_c", "text")

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                out = []
                for (_, s), (_, t) in zip(_sets(part, 2, size), _sets(part, 3, size), strict=True):
                    kept, old = np.isin(s, t, assume_unique=True), np.isin(t, s, assume_unique=True)
                    o = int(old.sum())
                    j = o / (len(s) + len(t) - o)
                    near = j >= NEAR
                    out.append((len(s), len(t), o, j, np.packbits(~kept).tobytes() if near else None, _signed(t[~old]) if near else None))
                kinds = (pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.binary(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True))],
                    names=["c", "cls", "n_c", "n", "o", "j", "lacks", "more"])

    return at.mapInArrow(run, "c long, cls long, n_c int, n int, o int, j double, lacks binary, more array<long>")


def _near_links(near: DataFrame) -> DataFrame:
    """Links (a, b) across components between classes near one centre, from their differences to it.

    Classes outside the centre's main component meet all others, in blocks; of a
    class's links with one component one is returned.
    """
    # A class weighs one, or more if its differences are long: a block holds about BLOCK of weight.
    near = near.withColumn("w", 1 + F.floor((F.octet_length("lacks") + 8 * F.size("more")) / BLOCK_BYTES))
    comps = near.groupBy("c", "comp").agg(F.sum("w").alias("k"))
    main = comps.groupBy("c").agg(F.max(F.struct("k", "comp")).alias("m"), F.sum("k").alias("all"), F.count("*").alias("comps"))
    main = main.where("comps > 1").select("c", F.col("m.comp").alias("main"), F.col("m.k").alias("k"), "all")
    at = near.join(main, "c").withColumn("rest", F.col("comp") != F.col("main"))
    weight = F.when(F.col("rest"), F.col("all") - F.col("k")).otherwise(F.col("k"))
    at = at.withColumn("block", F.pmod(F.xxhash64("cls"), F.ceil(weight / BLOCK)))
    blocks = checkpointed(near.sparkSession, at.groupBy("c", "rest", "block").agg(
        F.first("n_c").alias("n_c"), F.collect_list(F.struct("cls", "n", "comp", "lacks", "more")).alias("m")))
    side = lambda x: blocks.select("c", "n_c", *(F.col(k).alias(f"{k}_{x}") for k in ("rest", "block", "m")))
    both = side("x").where("rest_x").join(side("y").drop("n_c"), "c").where("NOT rest_y OR block_x <= block_y")

    def run(batches):
        num, den = THRESHOLD
        for batch in batches:
            for n_c, x, y in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                found = _block_links(n_c, x, y, num, den)
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["a", "b"])

    return both.select("n_c", "m_x", "m_y").mapInArrow(run, "a long, b long").distinct()


def _block_links(n_c: int, x: list[dict], y: list[dict], num: int, den: int) -> set[tuple[int, int]]:
    bits = [np.frombuffer(b"".join(m["lacks"] for m in side), np.uint8).reshape(len(side), -1) for side in (x, y)]
    size = [np.array([m["n"] for m in side], np.int64) for side in (x, y)]
    comp = [np.array([m["comp"] for m in side], np.int64) for side in (x, y)]
    rows: list[dict[int, list[int]]] = [{}, {}]
    for side, at in zip((x, y), rows, strict=True):
        for i, m in enumerate(side):
            for h in m["more"]:
                at.setdefault(h, []).append(i)
    common = np.zeros((len(x), len(y)), np.int64)  # shingles that both have and the centre lacks
    for h, i in rows[0].items():
        if h in rows[1]:
            common[np.ix_(i, rows[1][h])] += 1
    step = max(1, (1 << 24) // max(1, bits[1].size))
    for i in range(0, len(x), step):
        either = np.bitwise_count(bits[0][i:i + step, None, :] | bits[1][None]).sum(-1, dtype=np.int64)
        common[i:i + step] += n_c - either
    both = size[0][:, None] + size[1][None]
    hit = (common * den >= (both - common) * num) & (comp[0][:, None] != comp[1][None])
    found = set()
    for i in np.flatnonzero(hit.any(1)):
        at = np.flatnonzero(hit[i])
        for j in at[np.unique(comp[1][at], return_index=True)[1]]:
            found.add((min(x[i]["cls"], y[j]["cls"]), max(x[i]["cls"], y[j]["cls"])))
    return found


def _far_pairs(lists: DataFrame) -> DataFrame:
    """Pairs of a list's classes in different components that are not both near its centre; their similarities to
    the centre (j; -1: not known, for unlike signatures) must be as close as the triangle inequality of Jaccard distances
    demands of a link, and their signatures must allow it."""
    num, den = THRESHOLD
    side = lambda x: lists.select("v", *(F.col(c).alias(f"{c}_{x}") for c in ("cls", "n", "comp", "j", "bits")))
    at = side("a").join(side("b"), "v").where(_possible(
        f"cls_a < cls_b AND comp_a <> comp_b AND least(j_a, j_b) < {NEAR} AND "
        f"(least(j_a, j_b) < 0 OR abs(j_a - j_b) <= {1 - num / den + 1e-9}) AND {_alike(_differing('bits_a', 'bits_b'))}"))
    return at.select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b")).distinct()


def link(spark: SparkSession, docs: DataFrame, size: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    small_batches(spark)
    found = checkpointed(spark, postings(docs, doc_id, text, size, rarity(docs, text, size)))
    ids = found.where(F.col("cls").isNotNull()).groupBy("doc_id").agg(F.min("cls").alias("x"), F.max("cls").alias("y"))
    where = (found, ids.where("x <> y").limit(1).count() > 0, docs, doc_id, text, size)
    lists = checkpointed(spark, _shared(found))
    release(spark)
    classes = checkpointed(spark, found.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.first("n").alias("n"), F.first("bits").alias("bits")))
    tried = checkpointed(spark, _hopeful(_star(lists), classes))
    release(spark)
    links = checkpointed(spark, _verified(tried, *where))
    release(spark)
    labels = components(spark, links)
    # Lists of two classes are settled; longer ones may hold further links.
    short = checkpointed(spark, _hopeful(_short_pairs(lists, labels), classes).join(tried, ["a", "b"], "left_anti"))
    release(spark)
    if short.limit(1).count():
        tried = tried.union(short)
        labels = merged(spark, labels, checkpointed(spark, _verified(short, *where)))
        release(spark)
    longer = checkpointed(spark, _centred(_open(lists.where(f"k > {SHORT}").select("v", "cls", "n"), labels)))
    release(spark)
    if not longer.limit(1).count():
        return _labelled(found, labels)
    centre = classes.select(F.col("cls").alias("c"), F.col("n").alias("n_c"), F.col("bits").alias("bits_c"))
    differing = _differing("bits", "bits_c")
    members = longer.select("c", "cls").distinct().join(classes, "cls").join(centre, "c").where(
        f"{differing} <= IF(greatest(n, n_c) <= {K}, (n + n_c) div 3, {LIKE})").select("c", "cls")
    members = checkpointed(spark, members)
    members = checkpointed(spark, _differences(members, _texts(members.select("cls").distinct(), *where), size))
    num, den = THRESHOLD
    linked = F.expr(f"o * {den} >= (n + n_c - o) * {num}")
    links = members.where("c <> cls").where(linked).select(
        F.least("c", "cls").alias("a"), F.greatest("c", "cls").alias("b"))
    # What is linked to the centre is in the centre's component.
    centres = labels.select(F.col("node").alias("c"), F.col("component").alias("comp_c"))
    near = _relabelled(members.where(f"j >= {NEAR}"), labels).join(centres, "c", "left")
    near = near.withColumn("comp", F.when(linked, F.coalesce("comp_c", "c")).otherwise(F.col("comp"))).drop("comp_c")
    labels = merged(spark, labels, links.union(checkpointed(spark, _near_links(near))))
    release(spark)
    longer = longer.join(members.select("c", "cls", "j"), ["c", "cls"], "left").withColumn("j", F.coalesce("j", F.lit(-1.0)))
    longer = _open(longer, labels, "j").join(classes.select("cls", "bits"), "cls")
    rest = checkpointed(spark, _far_pairs(checkpointed(spark, longer)).join(tried, ["a", "b"], "left_anti"))
    if rest.limit(1).count():
        labels = merged(spark, labels, checkpointed(spark, _verified(rest, *where)))
        release(spark)
    return _labelled(found, labels)


def _labelled(found: DataFrame, labels: DataFrame) -> DataFrame:
    at = found.select("doc_id", "n", "cls").join(labels.withColumnRenamed("node", "cls"), "cls", "left")
    at = at.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "cls").alias("comp"))
    least = at.where(F.col("comp").isNotNull()).groupBy("comp").agg(F.min("doc_id").alias("least"))
    at = at.join(least, "comp", "left")
    at = at.select("doc_id", "n_shingles", F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))
    return at.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(spark: SparkSession, docs: DataFrame, size: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows (all columns) with the least id of their group, null ids last; a row that repeats id and text stays once.

    Rows are told apart by id and text, so a null or repeated id takes no other text with it.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    row = F.struct(F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), F.xxhash64(t).alias("hash"), F.length(t).alias("length"))
    at = docs.withColumn("__row", row)
    found = checkpointed(spark, link(spark, at.select("__row", text), size, "__row", text))
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    if gone.count() <= BROADCAST_ROWS:
        gone = F.broadcast(gone)
    left = at.join(gone, F.col("__row").eqNullSafe(F.col("__gone")), "left_anti")
    again = found.where("kept").groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1")
    return (left.dropDuplicates(["__row"]) if again.limit(1).count() else left).drop("__row")
