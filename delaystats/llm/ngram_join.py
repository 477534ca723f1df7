"""Exact Jaccard self-join of documents on word n-grams by PartEnum signatures.

A document is the set of its distinct n-word shingles (64-bit hashes of the
ASCII-lower-cased words).  Sets of a size band [l, r] with Jaccard >= gamma
differ in at most k = floor((|A|+|B|)(1-gamma)/(1+gamma)) <= 2r(1-gamma)/(1+gamma)
elements.  PartEnum cuts the feature domain (ranges of the hash) into n1
first-level partitions, each into n2 second-level ones, and enumerates the
subsets of n2 - k2 of the latter: of n1 = k div (k2+1) + 1 + m first-level
partitions at least m + 1 hold at most k2 differences, and in each of those
some enumerated subset has no difference, so both sets share its signature.

The m spare partitions let a set leave out *sparse* signatures (projections
of fewer than t elements, which unrelated sets share by chance): a first-level
partition is poor when one of its subsets is sparse; a set with at most m poor
partitions emits no sparse signature, any other set emits all.  Two similar
sets agree on m + 1 partitions; if either has at most m poor ones, an agreed
partition is not poor in it, and the agreed projection there is not sparse in
both; if both have more, both emit everything.  So no link is lost.

Sizes are cut at ratio gamma; a set emits for its own band and the next one,
so two sets of similar size always meet in the band of the larger.

Plan (all shuffles hash on signatures or set ids, nothing is collected but a
bit map of fixed size):

1. One Arrow pass emits (signature, set); equal sets of a task emit once.
   The rows are shuffled by signature, sorted by Spark (spilling), and streamed:
   only signatures shared by two different sets survive (G).
2. A second pass computes every document's set key and, for sets in a bounded
   map of G, the set itself; a saturated map only lets more sets pass.  Similar
   sets agree on m + 1 partitions, and a set with p <= m poor ones emits the
   agreed signatures of m + 1 - p of them at least, as does the other set; so a
   set that shares fewer signatures, which the map tells, links with nothing.
3. Elements found in no other set of G bound what a set can share: sets with
   more than 1 - gamma of them link with nothing and leave G.
4. Star rounds: a set is tested against hubs, the sets with the most common
   signatures of their groups, first the best one, then, where a signature's
   sets are not all in one component, that signature's hub.  Members of a
   hub are salted by their number.
5. For sets x, y with distances a, b from a common hub and ux, uy elements of
   their own, |x ^ y| >= a + b - 2 min(a - ux, b - uy).  Sets that no other
   one of the group can reach by this bound leave it (per-group minima, no
   pairs); what is left of different components is paired under the bound
   and under that of their sketches (the parities of the elements in each of
   SKETCH_BITS cells: every element of only one set flips one, so two sets
   differ in as many elements, at least, as their sketches do in bits), each
   pair once, and tested.  So no pair of different texts stays untested
   unless a bound rules it out or it is already connected.  Sets that share a
   passage by chance are many pairs, and only their sketches are moved.

Equal sets are one class and are never paired with each other.
"""

from __future__ import annotations

import itertools
import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from delaystats.llm.common import forget, free_names, lean, written

BITMAP_BITS = 1 << 24          # candidate bit map: 2 MB, whatever the input
STAR_PIECE = 2000              # members of one hub tested in one group
SEEN_SETS = 200_000            # equal sets remembered per task
BATCH_ROWS = 200_000           # signatures that go to Spark at a time
LEVELS = (1, 2, 4)             # shared signatures that the map of G tells apart
SKETCH_BITS = 1 << 11          # sets of up to 2 500 elements or so are told apart by it

_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                             0xD6E8FEB86659FD93)]


_MEMO: dict = {}


def _once(f, *args):
    """f(*args), kept in the task (few bands, so few entries)."""
    key = (f.__name__, *args)
    if key not in _MEMO:
        _MEMO[key] = f(*args)
    return _MEMO[key]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, n: int = 4) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; a shorter text
    with words is one shingle, a text without words the empty set."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    m = len(h) - n + 1
    if m < 1:
        acc = np.uint64(len(h))
        for x in h:
            acc = _mix(np.array([acc ^ x]) * _C[0])[0]
        return np.array([acc])
    acc = h[:m].copy()
    for i in range(1, n):
        acc = _mix(acc * _C[0] + np.uint64(i)) ^ h[i:i + m]
    return np.unique(_mix(acc))


def bands(gamma_num: int, gamma_den: int, top: int) -> tuple[int, ...]:
    """Upper ends of the size bands up to one that covers ``top``: a band
    holds the sizes from one above the previous end to its own end, and the
    smallest size similar to any size of a band lies in it or the one before."""
    ends, r = [], 0
    while r < top:
        low = r + 1
        r = low * gamma_den // gamma_num
        ends.append(r)
    return tuple(ends)


def scheme(size: int, smallest: int, gamma_num: int, gamma_den: int) -> tuple[int, int, int, int, int]:
    """(n1, n2, k2, m, t) for a band that ends at ``size`` and gets sets of
    ``smallest`` elements and more."""
    k = 2 * size * (gamma_den - gamma_num) // (gamma_den + gamma_num)
    if k == 0:
        return 1, 1, 0, 0, 0
    if k <= 3:
        return 1, (4, 5, 6)[k - 1], k, 0, 0
    base = k // 2 + 1
    for t in (2, 1):
        for m in range(base):
            lam = smallest / (2 * (base + m))
            poor = 1 - (1 - math.exp(-lam) * (1 + lam * (t - 1))) ** 2
            mean = (base + m) * poor
            if m >= mean + 3 * math.sqrt(mean):
                if m <= base // 2:
                    return base + m, 2, 1, m, t
                break
    return base, 2, 1, 0, 0


def _subsets(n2: int, k2: int) -> np.ndarray:
    """0/1 rows: the enumerated subsets of n2 - k2 second-level partitions."""
    rows = list(itertools.combinations(range(n2), n2 - k2))
    out = np.zeros((len(rows), n2), np.uint64)
    for i, r in enumerate(rows):
        out[i, list(r)] = 1
    return out


def _cuts(s: np.ndarray, gamma_num: int, gamma_den: int):
    """For each band that the set emits for: the band, the elements in each
    second-level partition, the enumerated subsets, which of them are sparse
    (None: all are emitted) and how many signatures similar sets share at least."""
    size = len(s)
    ends = _once(bands, gamma_num, gamma_den, 1 << (2 * size + 4).bit_length())
    own = bisect_left(ends, size)
    high = s >> np.uint64(32)
    for b in (own, own + 1):
        below = ends[b - 2] if b >= 2 else 0
        n1, n2, k2, m, t = _once(scheme, ends[b], below + 1, gamma_num, gamma_den)
        if b > own and size * gamma_den < gamma_num * (ends[own] + 1):
            continue        # no size of the next band is similar to this one
        cells = n1 * n2
        cell = (high * np.uint64(cells)) >> np.uint64(32)
        counts = np.bincount(cell.astype(np.int64), minlength=cells).reshape(n1, n2)
        subsets = _once(_subsets, n2, k2)
        sparse, least = None, 1
        if t:
            held = counts.astype(np.uint64) @ subsets.T < t
            poor = int(held.any(axis=1).sum())
            if poor <= m:
                sparse, least = held, m + 1 - poor
        yield b, counts, subsets, sparse, least


def signatures(s: np.ndarray, gamma_num: int = 85, gamma_den: int = 100) -> np.ndarray:
    """PartEnum signatures of a sorted set of 64-bit hashes."""
    if not len(s):
        return np.empty(0, np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(s * _C[1]), dtype=np.uint64)))
    out = []
    for b, counts, subsets, sparse, _ in _cuts(s, gamma_num, gamma_den):
        at = np.concatenate((np.zeros(1, np.int64), np.cumsum(counts)))
        part = (sums[at[1:]] - sums[at[:-1]]).reshape(counts.shape)
        sig = part @ subsets.T
        tag = np.arange(sig.size, dtype=np.uint64).reshape(sig.shape) + np.uint64(b << 40)
        sig = _mix(sig ^ _mix(tag * _C[2] + np.uint64(1)))
        out.append(sig.ravel() if sparse is None else sig[~sparse])
    return np.concatenate(out)


def least_shared(s: np.ndarray, gamma_num: int = 85, gamma_den: int = 100) -> int:
    """So many signatures, at least, has a set in common with any similar one."""
    return min(least for *_, least in _cuts(s, gamma_num, gamma_den))


def _key(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that name the set (as signed longs)."""
    if not len(s):
        return 0, 0
    a = _mix(s ^ _C[3]).sum(dtype=np.uint64)
    b = _mix(s * _C[2] + np.uint64(7)).sum(dtype=np.uint64)
    pair = _mix(np.array([a ^ np.uint64(len(s)), b]))
    return tuple(int(x) for x in pair.view(np.int64))


def _signature_rows(n: int, num: int, den: int):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            sigs, nodes, rows = [], [], 0
            for text in batch.column(0).to_pylist():
                s = shingle_set(text, n)
                key = _key(s)[0]
                if not len(s) or key in seen:
                    continue
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(key)
                g = signatures(s, num, den)
                sigs.append(g)
                nodes.append(np.full(len(g), key, np.int64))
                rows += len(g)
                if rows > BATCH_ROWS:
                    yield _batch(sigs, nodes)
                    sigs, nodes, rows = [], [], 0
            if sigs:
                yield _batch(sigs, nodes)
    return fn


def _batch(sigs, nodes) -> pa.RecordBatch:
    return pa.record_batch({"sig": pa.array(np.concatenate(sigs).view(np.int64)),
                            "node": pa.array(np.concatenate(nodes))})


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (sig, node): the distinct ones whose signature has
    two nodes or more.  Holds one batch and one row."""
    held = None         # last row so far: sig, node, and whether it was emitted
    for batch in batches:
        sig, node = (np.asarray(batch.column(i)) for i in (0, 1))
        if not len(sig):
            continue
        if held is not None:
            sig, node = np.append(held[0], sig), np.append(held[1], node)
        fresh = np.ones(len(sig), bool)
        fresh[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
        emitted = bool(held and held[2])
        sig, node = sig[fresh], node[fresh]
        same = np.zeros(len(sig) + 1, bool)
        same[1:-1] = sig[1:] == sig[:-1]
        keep = same[:-1] | same[1:]
        held = (sig[-1], node[-1], bool(keep[-1]) or (emitted and len(sig) == 1))
        out = keep.copy()
        if emitted:
            out[0] = False
        if out.any():
            yield pa.record_batch({"sig": pa.array(sig[out]), "node": pa.array(node[out])})


def _set_rows(n: int, bits: bytes, num: int, den: int):
    """Set keys, and the sets whose level in ``bits`` (two bits each) says that
    they share enough signatures."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = len(bits) * 4 - 1
        seen: set[int] = set()
        for batch in batches:
            size, k1, k2, sets = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, n)
                a, b = _key(s)
                at = a & mask
                blob = None
                level = bits[at >> 2] >> (at & 3) * 2 & 3 if len(s) and a not in seen else 0
                if level == len(LEVELS) or level and _level(least_shared(s, num, den)) <= level:
                    if len(seen) >= SEEN_SETS:
                        seen.clear()
                    seen.add(a)
                    blob = s.tobytes()
                size.append(len(s))
                k1.append(a)
                k2.append(b)
                sets.append(blob)
            yield pa.record_batch({"doc_id": batch.column(0), "n_shingles": pa.array(size, pa.int64()),
                                   "node": pa.array(k1, pa.int64()), "key2": pa.array(k2, pa.int64()),
                                   "elements": pa.array(sets, pa.binary())})
    return fn


def _level(n: int) -> int:
    """The number of LEVELS up to n."""
    return sum(n >= x for x in LEVELS)


def _bitmap(nodes: DataFrame, width: int = 1) -> bytes:
    """Fixed-size bit map of the candidate sets, or-ed together by Spark; a wider
    one has the column ``level`` of ``width`` bits for each set."""
    at = F.col("node").bitwiseAND(F.lit(BITMAP_BITS - 1))
    per = 64 // width
    level = F.col("level").cast("bigint") if width > 1 else F.lit(1).cast("bigint")
    words = (nodes.select(F.shiftright(at, per.bit_length() - 1).alias("w"), level.alias("v"),
                          (at.bitwiseAND(F.lit(per - 1)) * width).cast("int").alias("b"))
             .groupBy("w").agg(F.expr("bit_or(shiftleft(v, b))").alias("v"))).toArrow()
    out = np.zeros(BITMAP_BITS // per, np.uint64)
    out[words.column("w").to_numpy()] = words.column("v").to_numpy().view(np.uint64)
    return out.astype("<u8").tobytes()


def _levels(shared: DataFrame) -> DataFrame:
    """Each set of G and the level of the number of its signatures there."""
    n = F.count("*")
    return shared.groupBy("node").agg(sum((n >= x).cast("int") for x in LEVELS).alias("level"))


def _tested(num: int, den: int):
    """Rows sorted by (hub, salt, member first 0 = the hub itself): the links."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, hub_set = None, None
        for batch in batches:
            a, b, dist, link = [], [], [], []
            hubs, salts, is_member, nodes, sets = (batch.column(i).to_pylist() for i in range(5))
            for hub, salt, member, node, blob in zip(hubs, salts, is_member, nodes, sets):
                s = np.frombuffer(blob, np.uint64)
                if not member:
                    at, hub_set = (hub, salt), s
                elif at == (hub, salt):
                    both = len(np.intersect1d(hub_set, s, assume_unique=True))
                    a.append(hub)
                    b.append(node)
                    dist.append(len(s) + len(hub_set) - 2 * both)
                    link.append(den * both >= num * (len(s) + len(hub_set) - both))
            if a:
                yield pa.record_batch({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()),
                                       "dist": pa.array(dist, pa.int64()), "link": pa.array(link)})
    return fn


def _verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Distance of each pair (a, b) and whether it links.  Every hub a is sent to ceil(members /
    STAR_PIECE) places, so a hub of a third of all sets is spread out."""
    spread = pairs.groupBy("a").agg(F.ceil(F.count("*") / STAR_PIECE).cast("int").alias("n"))
    hubs = (spread.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
            .select(F.col("a").alias("hub"), "salt", F.lit(0).alias("member"), F.col("a").alias("node")))
    needed = pairs.select(F.col("a").alias("node")).unionAll(pairs.select(F.col("b").alias("node"))).distinct()
    sets = sets.mapInArrow(_kept_sets(_bitmap(needed)), "node long, elements binary")
    members = (pairs.join(spread, "a")
               .select(F.col("a").alias("hub"), F.pmod(F.xxhash64("b"), F.col("n")).cast("int").alias("salt"),
                       F.lit(1).alias("member"), F.col("b").alias("node")))
    rows = hubs.unionByName(members).join(sets, "node").select("hub", "salt", "member", "node", "elements")
    return (rows.repartition("hub", "salt").sortWithinPartitions("hub", "salt", "member", "node")
            .mapInArrow(_tested(num, den), "a long, b long, dist long, link boolean").distinct())


def _kept_sets(bits: bytes):
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(bits, np.uint8)
        for batch in batches:
            at = np.asarray(batch.column(0)) & (8 * len(table) - 1)
            yield batch.filter(pa.array((table[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
    return fn


def _sketch(s: np.ndarray) -> np.ndarray:
    """The parity of the number of elements in each of SKETCH_BITS cells, as signed longs."""
    cell = _mix(s * _C[3]) & np.uint64(SKETCH_BITS - 1)
    odd = np.bincount(cell.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat = [_sketch(np.frombuffer(x, np.uint64)) for x in batch.column(1).to_pylist()]
        ends = np.arange(len(flat) + 1) * (SKETCH_BITS // 64)
        yield pa.record_batch({"node": batch.column(0), "sketch": pa.ListArray.from_arrays(
            pa.array(ends, pa.int32()), pa.array(np.concatenate(flat or [np.empty(0, np.int64)])))})


def _differ(x: str, y: str) -> Column:
    """The number of bits that two sketches differ in."""
    bits = F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    return F.aggregate(bits, F.lit(0), lambda n, b: n + b)


def _element_rows(sample: int):
    """(element, node) of the elements whose hash falls in ``sample`` of 8 parts."""
    def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                sets = [np.frombuffer(x, np.int64) for x in part.column(1).to_pylist()]
                nodes = np.repeat(np.asarray(part.column(0)), [len(x) for x in sets])
                elements = np.concatenate(sets)
                keep = (elements & 7) < sample
                yield pa.record_batch({"element": pa.array(elements[keep]), "node": pa.array(nodes[keep])})
    return fn


def _able(sets: DataFrame, sample: int, num: int, den: int) -> DataFrame:
    """Sets that can link with another one of ``sets``: size n, and the number
    u of their elements, of ``sample`` of 8 parts, that no other set has."""
    own = (sets.mapInArrow(lean(_element_rows(sample)), "element long, node long")
           .groupBy("element").agg(F.min("node").alias("node"), F.max("node").alias("other"))
           .where("node = other").groupBy("node").agg(F.count("*").alias("u")))
    sizes = sets.select("node", (F.length("elements") / 8).cast("long").alias("n")).distinct()
    return (sizes.join(own, "node", "left").select("node", "n", F.coalesce("u", F.lit(0)).alias("u"))
            .where(F.lit(den) * (F.col("n") - F.col("u")) >= F.lit(num) * F.col("n")))


def _with_own_elements(shared: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The rows of G whose set can still link, with its size n and the number
    u of its elements that no other such set has.

    Unrelated sets are mostly elements of their own, and three parts of eight
    show it; only what these leave is counted in full."""
    first = written(_able(sets, 3, num, den).select("node"), "able")
    sets = sets.mapInArrow(_kept_sets(_bitmap(first)), "node long, elements binary")
    return shared.join(first, "node", "left_semi").join(_able(sets, 8, num, den), "node")


def _with_hubs(rows: DataFrame) -> DataFrame:
    """Signatures of two sets or more, each with its hub: of its sets the one
    with the most companions over all signatures."""
    groups = rows.groupBy("sig").agg((F.count("*") - 1).alias("others")).where("others > 0")
    rows = rows.join(groups, "sig")
    score = rows.groupBy("node").agg(F.sum("others").alias("score"))
    rows = rows.join(score, "node").drop("others")
    hubs = rows.groupBy("sig").agg(F.max(F.struct("score", "node")).alias("hub"))
    return rows.join(hubs, "sig").select("sig", "node", "n", "u", F.col("hub.node").alias("hub"),
                                         F.col("hub.score").alias("score"))


def _open(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows of the signatures whose sets are not all in one component."""
    rows = rows.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    sigs = (rows.groupBy("sig").agg((F.min("comp") != F.max("comp")).alias("open"))
            .where("open").select("sig"))
    return rows.join(sigs, "sig")


def components(links: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over links (a, b).  Smallest
    neighbour label, then a jump to the label's label, until nothing changes."""
    edges = written(links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                    .distinct(), "edges")
    labels = written(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("comp"))
                     .select(F.col("a").alias("node"), "comp"), "labels")
    while True:
        near = (edges.join(labels, edges.b == labels.node).groupBy(F.col("a").alias("node"))
                .agg(F.min("comp").alias("near")))
        step = labels.join(near, "node").select("node", "comp", F.least("comp", "near").alias("new"))
        jump = labels.select(F.col("node").alias("new"), F.col("comp").alias("far"))
        new = written(step.join(jump, "new")
                      .select("node", F.least("new", "far").alias("comp"),
                              (F.least("new", "far") != F.col("comp")).alias("changed")), "labels")
        labels = new.select("node", "comp")
        if not new.where("changed").take(1):
            return labels


def _reachable(rows: DataFrame, tested: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Untested pairs of different components that the bounds of hubs and
    sketches allow: with p = (num+den)(2u - a) - (den-num) n and
    q = (num+den) a - (den-num) n, a pair x, y can link only if
    p(x) + q(y) <= 0 and p(y) + q(x) <= 0."""
    step = den - num
    rows = (rows.where("hub != node")
            .join(tested.select(F.col("a").alias("hub"), F.col("b").alias("node"), "dist"), ["hub", "node"])
            .withColumn("p", (num + den) * (2 * F.col("u") - F.col("dist")) - step * F.col("n"))
            .withColumn("q", (num + den) * F.col("dist") - step * F.col("n")))
    for _ in range(2):
        least = rows.groupBy("sig").agg(F.min("p").alias("least_p"), F.min("q").alias("least_q"),
                                        F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        rows = (rows.join(least.where("lo != hi").drop("lo", "hi"), "sig")
                .where("least_p + q <= 0 and p + least_q <= 0").drop("least_p", "least_q"))
    rows = written(rows.select("sig", "node", "n", "comp", "p", "q"), "reachable")
    groups = (rows.groupBy("sig").agg(F.count("*").alias("m"), F.sum(F.xxhash64("node").cast("decimal(38,0)"))
                                      .alias("members"))
              .groupBy("m", "members").agg(F.min("sig").alias("sig")).select("sig"))
    rows = rows.join(groups, "sig")
    # a pair is made by the smallest of its common signatures only
    own = rows.groupBy("node").agg(F.collect_list("sig").alias("sigs"))
    sketches = sets.mapInArrow(_sketch_rows, "node long, sketch array<long>")
    rows = rows.join(own.join(sketches, "node"), "node")
    columns = ("node", "n", "comp", "p", "q", "sigs", "sketch")
    x = rows.select("sig", *[F.col(c).alias(f"x_{c}") for c in columns])
    y = rows.select("sig", *[F.col(c).alias(f"y_{c}") for c in columns])
    return (x.join(y, "sig")
            .where(F.expr("x_node < y_node and x_comp != y_comp and x_p + y_q <= 0 and y_p + x_q <= 0")
                   & ((num + den) * _differ("x_sketch", "y_sketch") <= step * (F.col("x_n") + F.col("y_n")))
                   & F.expr("array_min(array_intersect(x_sigs, y_sigs)) = sig"))
            .select(F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct()
            .join(tested.select("a", "b"), ["a", "b"], "left_anti")
            .join(tested.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti"))


def _prepared(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str):
    """Every document's set key, the sets that can link, and their signatures with hubs."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = source.select("text").mapInArrow(lean(_signature_rows(n, num, den)), "sig long, node long")
    shared = written(rows.repartition("sig").sortWithinPartitions("sig", "node")
                     .mapInArrow(lean(_shared), "sig long, node long"), "shared")
    bits = _bitmap(_levels(shared), 2)
    keyed = written(source.mapInArrow(lean(_set_rows(n, bits, num, den)), "doc_id long, n_shingles long, node long, "
                                      "key2 long, elements binary"), "sets")
    sets = keyed.where("elements is not null").select("node", "elements")

    linkable = written(_with_own_elements(shared, sets, num, den), "linkable")     # the counts' shuffles go first
    forget(shared)
    rows = written(_with_hubs(linkable), "rows")
    forget(linkable)
    left = _bitmap(rows.select("node").distinct())
    sets = written(sets.mapInArrow(_kept_sets(left), "node long, elements binary"), "alive")
    keys = written(keyed.drop("elements"), "keys")
    forget(keyed)
    return keys, sets, rows


def ngram_links(docs: DataFrame, n: int = 4, similarity: tuple[int, int] = (85, 100),
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The join itself: a row per link of two different sets, each named by the
    smallest id of its documents (doc_a, doc_b) with the number of its rows
    (copies_a, copies_b).

    Unlike the components, no pair is left out for being connected already:
    every set is tested against all hubs of its signatures, and every other
    pair with a common signature that the bounds allow.
    """
    num, den = similarity
    keyed, sets, rows = _prepared(docs, n, num, den, id_col, text_col)
    pairs = rows.where("hub != node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    star = written(_verify(written(pairs, "pairs"), sets, num, den), "tested")
    pairs = _reachable(rows.withColumn("comp", F.col("node")), star, sets, num, den)
    more = _verify(written(pairs, "pairs"), sets, num, den)
    links = (star.unionAll(more).where("link")
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    named = (keyed.where("n_shingles > 0").groupBy("node")
             .agg(F.min("doc_id").alias("doc"), F.count("*").alias("copies")))
    for side in ("a", "b"):
        links = links.join(named.select(F.col("node").alias(side), F.col("doc").alias(f"doc_{side}"),
                                        F.col("copies").alias(f"copies_{side}")), side)
    return links.select("doc_a", "doc_b", "copies_a", "copies_b")


def ngram_components(docs: DataFrame, n: int = 4, similarity: tuple[int, int] = (85, 100),
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs``.

    Null text counts as empty; documents without words link with nothing and
    are their own component.  Repeated rows give repeated results.  A null id
    never names a component if another member has an id; a component of null
    ids only has a null component_id.  Rows with the same id but other texts
    are kept apart as texts and share the component of each.  Other columns
    are ignored, whatever their names; an empty table gives an empty result.
    """
    num, den = similarity
    keyed, sets, rows = _prepared(docs, n, num, den, id_col, text_col)

    best = (rows.where("hub != node").groupBy(F.col("node").alias("b"))
            .agg(F.max(F.struct("score", "hub")).alias("best")).select(F.col("best.hub").alias("a"), "b"))
    star = written(_verify(written(best, "pairs"), sets, num, den), "tested")
    labels = components(star.where("link"))

    rest = written(_open(rows, labels).drop("comp"), "open")
    forget(rows)
    pairs = (rest.where("hub != node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
             .join(star, ["a", "b"], "left_anti"))
    star = written(star.unionAll(_verify(written(pairs, "pairs"), sets, num, den)), "tested")
    labels = components(star.where("link"))

    pairs = _reachable(_open(rest, labels), star, sets, num, den)
    more = written(_verify(written(pairs, "pairs"), sets, num, den), "tested")
    labels = components(star.unionAll(more).where("link"))
    classes = (keyed.groupBy("n_shingles", "node", "key2").agg(F.min("doc_id").alias("first"))
               .join(labels, "node", "left"))
    named = classes.withColumn("comp", F.coalesce("comp", "node"))
    heads = named.groupBy("comp").agg(F.min("first").alias("component_id"))
    named = named.join(heads, "comp").select("n_shingles", "node", "key2", "component_id")
    full = (keyed.where("n_shingles > 0").select("doc_id", "n_shingles", "node", "key2")
            .join(named, ["n_shingles", "node", "key2"])
            .select("doc_id", "n_shingles", "component_id"))
    empty = keyed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionAll(empty)


def keep_one(docs: DataFrame, n: int = 5, similarity: tuple[int, int] = (80, 100),
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns kept, that name their component: one
    document of each group of near copies, the one with the smallest id.

    Documents without words all stay, as do rows without an id.  Rows that
    share an id are one document where their texts are equal.
    """
    found = ngram_components(docs.select(id_col, text_col), n, similarity, id_col, text_col)
    own, count = free_names(docs, 2)
    named = found.where("doc_id = component_id").groupBy(F.col("doc_id").alias(own)).agg(F.count("*").alias(count))
    rows = docs.join(named, F.col(id_col) == F.col(own)).drop(own)
    once, more = rows.where(F.col(count) == 1), rows.where(F.col(count) > 1).dropDuplicates([id_col, text_col])
    return once.unionAll(more).drop(count).unionAll(docs.where(F.col(id_col).isNull()))
