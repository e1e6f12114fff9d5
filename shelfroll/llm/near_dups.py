"""MinHash near-duplicate detection with exact confirmation.

1. Every document becomes a set of word shingles; ``HASHES`` universal hash minima form its signature (the low 16 bits of
   each minimum are kept). Documents with the same set share a fingerprint (a 64-bit sum over the set), which is the
   node that stands for all of them: copies cost one row each and are never paired.
2. Signatures are cut into ``BANDS`` bands of ``ROWS``. A pair at similarity 0.8 shares no band with probability below
   1e-7.
3. Linear rounds: every node is compared with one centre, the smallest node of all its buckets. Then, while that joins
   components, the nodes of each bucket that still holds several are compared with a centre of that bucket: in turn a
   node of its largest component, and of one by chance. A round sends one row a node and bucket at most.
4. The buckets that still hold several components are searched whole. Pairs inside a component need no test, as they
   can't join components; so the members of a bucket's largest component are dealt once, to blocks, and only the
   others meet every block. All pairs of different components whose signatures agree well are sent, each at its first
   shared band, as lists of partners.
5. Whatever is sent is confirmed on the full sets. Components: alternating large-star and small-star until the edges
   stay the same, on the components of the round before.

Full sets are made once, from the texts of the documents that stand for a node of a shared bucket (a join on the
document, with its keys broadcast up to a stated number of them). Pairs are confirmed by the piece of a
bucket that sent them (``PART`` members a side), so a set travels once for each piece and not once for each pair.

Links are exact except for the bands' and the signature test's miss probability (agreement below ``percent`` less four
standard errors). Hot buckets: with l members in the largest component and o others, the search moves
l * ceil(o / BLOCK) + o * (ceil(l / BLOCK) + ceil(o / BLOCK)) rows: l + 2 o up to BLOCK members each, whatever the number
of components.

Edge cases: null and empty texts have an empty set and are linked with nothing, each its own component; rows with equal
doc_id are documents of their own; a null doc_id takes part, and a component's id is the smallest that isn't null (null
if there is none); fewer words than a shingle: the whole sequence is the one shingle; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SPACES, blocks, id_and_text, mix, span_hashes, stored, temporary, words_of

HASHES, BANDS, ROWS = 256, 32, 4
SEED = 20_240_601
PART = 512  # nodes a side whose sets are held together
BLOCK = 8 * PART  # nodes a side whose signatures are held together
STALLED = 20  # linear rounds end when one joins fewer than one in so many of the nodes it tested
BROADCAST_ROWS = 4_000_000  # of 8 bytes
PIECE = ("bucket", "x", "y")  # a bucket's members cut into parts, and two of the parts
#: A node of a piece and the partners it is to be tested with; a node without partners is needed as a partner.
LISTS = "bucket long, x int, y int, a long, partners array<bigint>"
BLOCK_BYTES = 1 << 20


def coefficients() -> tuple[np.ndarray, np.ndarray]:
    """Multipliers (odd) and addends of the universal hash functions."""
    rng = np.random.default_rng(SEED)
    a = rng.integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, HASHES, np.uint64)


def shingle_sets(texts: list[bytes | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct 64-bit shingle hashes of all texts, first place of each text and the total)."""
    texts = [t.translate(LOWER) if t else t for t in texts]
    buf, starts, ends, first = words_of(texts, SPACES)
    word = span_hashes(buf, starts, ends)
    n = np.diff(first)
    owner = np.repeat(np.arange(len(texts)), n)
    # a shingle at every word; words beyond the text's end count as 0, so short texts have their whole sequence
    at = np.arange(len(word)) - first[:-1][owner]
    left = n[owner] - at
    use = (left >= width) | (at == 0)
    key = np.zeros(len(word), np.uint64)
    padded = np.append(word, np.zeros(width, np.uint64))
    for k in range(width):
        key = key * np.uint64(0xD1342543DE82EF95) + np.where(left > k, padded[k : k + len(word)], np.uint64(0))
    key = mix(key + np.minimum(left, width).astype(np.uint64))[use]
    owner = owner[use]
    order = np.lexsort((key, owner))
    key, owner = key[order], owner[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    key, owner = key[new], owner[new]
    return key, np.searchsorted(owner, np.arange(len(texts) + 1))


def minima(key: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Signature (HASHES x uint16) of each set: the low bits of the least upper half of (a * x + b) mod 2**64."""
    a, b = coefficients()
    out = np.zeros((len(first) - 1, HASHES), np.uint16)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        heads = first[:-1][full]
        for i in range(HASHES):
            least = np.minimum.reduceat(((key * a[i] + b[i]) >> np.uint64(32)).astype(np.uint32), heads)
            out[full, i] = least.astype(np.uint16)
    return out


def fingerprints(key: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit sum over each set: the node of the documents that have it."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(key + np.uint64(1)), dtype=np.uint64)])
    return mix(total[first[1:]] - total[first[:-1]]).view(np.int64)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text hash, set size, node (null for an empty set) and signature of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in blocks(batches, BLOCK_BYTES):
            key, first = shingle_sets(texts, width)
            sig = minima(key, first)
            n = np.diff(first)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": rows.column("doc_id"), "h": rows.column("h"), "n": pa.array(n, pa.int64()),
                    "id": pa.array(fingerprints(key, first), mask=n == 0), "sig": pa.array([s.tobytes() for s in sig], pa.binary()),
                }
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("h")).mapInArrow(
        run, "doc_id long, h long, n long, id long, sig binary"
    )


def band_keys(sig: np.ndarray) -> np.ndarray:
    """Bucket of each signature and band: a hash of the band's number and its ROWS minima."""
    rows = sig[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS).astype(np.uint64)
    packed = rows[:, :, 0] | rows[:, :, 1] << np.uint64(16) | rows[:, :, 2] << np.uint64(32) | rows[:, :, 3] << np.uint64(48)
    return mix(mix(packed) + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _read_signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, HASHES)


def _bands(reps: DataFrame) -> DataFrame:
    """(bucket, id) of every band of the nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            key = band_keys(_read_signatures(b.column("sig")))
            ids = np.repeat(b.column("id").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(ids)], names=["bucket", "id"])

    return reps.select("id", "sig").mapInArrow(run, "bucket long, id long")


def _lists(pairs: DataFrame) -> DataFrame:
    """Pairs (*PIECE, a, b) as rows of LISTS, one for each node of a piece (which holds about BLOCK nodes a side)."""
    own = pairs.select(*PIECE, "a", F.array("b").alias("partners"))
    every = own.union(pairs.select(*PIECE, F.col("b").alias("a"), F.expr("cast(array() AS array<bigint>)").alias("partners")))
    return every.groupBy(*PIECE, "a").agg(F.flatten(F.collect_list("partners")).alias("partners"))


def _agreement(pairs: DataFrame, reps: DataFrame, least: int) -> DataFrame:
    """Pairs (*PIECE, a, b) whose signatures agree in ``least`` places; all pairs of a piece have the same ``a``.

    The centre's signature is joined to its pieces, not to its pairs: a centre of many nodes is no hot key.
    """
    sigs = reps.select("id", "sig")
    centres = pairs.select(*PIECE, "a").distinct().join(sigs, F.col("a") == F.col("id")).select(*PIECE, F.col("sig").alias("sa"))
    small = F.broadcast(pairs) if pairs.count() <= BROADCAST_ROWS // 4 else pairs  # of 32 bytes
    joined = sigs.select(F.col("id").alias("b"), F.col("sig").alias("sb")).join(small, "b").join(centres, [*PIECE])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            ok = pa.array((_read_signatures(x.column("sa")) == _read_signatures(x.column("sb"))).sum(axis=1) >= least)
            yield x.select([*PIECE, "a", "b"]).filter(ok)

    return joined.select(*PIECE, "a", "b", "sa", "sb").mapInArrow(run, "bucket long, x int, y int, a long, b long")


def _sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(id, set) of the nodes (id, doc_id, h), read from a table; sets as sorted 64-bit numbers. A document without id is
    known by its text. Up to ``BROADCAST_ROWS`` nodes their keys are broadcast; beyond, texts are shuffled to them."""
    key = lambda text_hash: F.coalesce("doc_id", text_hash).alias("key")
    wanted = nodes.select(key(F.col("h"))).distinct()
    if nodes.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    known = docs.where("text IS NOT NULL").select("text", key(F.xxhash64("text"))).join(wanted, "key", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in blocks(batches, BLOCK_BYTES):
            key, first = shingle_sets(texts, width)
            sets = [key[s:e].tobytes() for s, e in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(fingerprints(key, first)), pa.array(sets, pa.binary())], names=["id", "set"])

    return known.select("text").mapInArrow(run, "id long, set binary").join(nodes.select("id"), "id", "left_semi").dropDuplicates(["id"])


def _confirmed(lists: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of a node and a partner of ``lists`` (LISTS, read from a table) with 100 * intersection >= percent *
    union on the full sets. Lists of up to ``BROADCAST_ROWS`` numbers are broadcast, so that the sets stay where they are."""
    numbers = lists.agg(F.sum(F.size("partners") + 4)).first()[0] or 0
    small = F.broadcast(lists) if numbers <= BROADCAST_ROWS else lists
    rows = sets.withColumnRenamed("id", "a").join(small, "a").select(*PIECE, "a", "partners", "set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())
        piece, held, wanted = None, {}, []

        def close() -> pa.RecordBatch:
            found = [(p, q) for p, partners in wanted for q in partners if _similar(held[p], held[q], percent)]
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for x in (batch.slice(lo, 500) for batch in batches for lo in range(0, batch.num_rows, 500)):
            columns = [x.column(c).to_pylist() for c in (*PIECE, "a", "partners", "set")]
            for g, i, j, p, partners, data in zip(*columns, strict=True):
                if piece != (g, i, j):
                    yield close()
                    piece, held, wanted = (g, i, j), {}, []
                held[p] = np.frombuffer(data, np.uint64)
                if partners:
                    wanted.append((p, partners))
        yield close()

    return rows.repartition(*PIECE).sortWithinPartitions(*PIECE).mapInArrow(run, "a long, b long")


def _similar(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have 100 * intersection >= percent * union."""
    if 100 * min(len(s), len(t)) < percent * max(len(s), len(t)):
        return False
    merged = np.concatenate([s, t])
    merged.sort(kind="stable")
    common = int((merged[1:] == merged[:-1]).sum())
    return 100 * common >= percent * (len(merged) - common)


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) of every node of ``edges`` (a, b): comp is the smallest id reachable.

    Alternating large-star and small-star; each round is written to the shared folder, so a lost executor costs one
    round at most, and only a count and a checksum come to the driver.
    """
    now = nodes = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")
    mark = None
    while True:
        # large star: every node sends its larger neighbours to the smallest of its neighbours and itself
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m0")).select("u", F.least("u", "m0").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # small star: every node sends its smaller neighbours and itself to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.union(low.select("u", F.col("m").alias("v"))).distinct()
        now = stored(small, "edges")
        after = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("s")).first()
        if mark == after:
            break
        mark = after
    roots = now.groupBy("u").agg(F.min("v").alias("comp")).select(F.col("u").alias("id"), "comp")
    every = nodes.select(F.explode(F.array("u", "v")).alias("id")).distinct()
    return every.join(roots, "id", "left").select("id", F.coalesce("comp", "id").alias("comp"))


def _joined(comp: DataFrame, links: DataFrame) -> DataFrame:
    """``comp`` (id, comp) after the links (a, b) between its nodes: components of the components."""
    ends = [comp.select(F.col("id").alias(c), F.col("comp").alias(f"c{c}")) for c in ("a", "b")]
    edges = links.join(ends[0], "a").join(ends[1], "b").where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct()
    after = components(edges).select(F.col("id").alias("comp"), F.col("comp").alias("_to"))
    return comp.join(after, "comp", "left").select("id", F.coalesce("_to", "comp").alias("comp"))


def _mixed(shared: DataFrame, comp: DataFrame) -> DataFrame:
    """Members (bucket, id, comp) of the buckets that hold several components, with the bucket's largest component
    ``top``, its members ``l`` and the ``o`` others."""
    members = shared.join(comp, "id").select("bucket", "id", "comp")
    per = members.groupBy("bucket", "comp").agg(F.count("*").alias("c"))
    top = per.groupBy("bucket").agg(F.count("*").alias("k"), F.max(F.struct("c", "comp")).alias("top"), F.sum("c").alias("m"))
    top = top.where("k > 1").select("bucket", F.col("top.comp").alias("top"), F.col("top.c").alias("l"), (F.col("m") - F.col("top.c")).alias("o"))
    return members.join(top, "bucket")


def _round(members: DataFrame, turn: int) -> DataFrame:
    """Pairs (*PIECE, a, b): a centre of each bucket with the bucket's nodes of other components.

    The centre is the node with the least hash, in even turns of the largest component only; the hash changes by turn.
    A node meets each centre once.
    """
    order = F.xxhash64(F.lit(turn), "bucket", "id")
    able = F.col("comp") == F.col("top") if turn % 2 == 0 else F.lit(True)
    centre = members.where(able).groupBy("bucket").agg(F.min_by(F.struct("id", "comp"), order).alias("centre"))
    pairs = members.join(centre, "bucket").where(F.col("comp") != F.col("centre.comp"))
    part = F.pmod(F.xxhash64("id"), F.ceil((F.col("l") + F.col("o")) / PART)).cast("int")
    pairs = pairs.select("bucket", part.alias("x"), F.lit(0).alias("y"), F.col("centre.id").alias("a"), F.col("id").alias("b"))
    first = pairs.groupBy("a", "b").agg(F.min(F.struct(*PIECE)).alias("p"))
    return first.select("p.bucket", "p.x", "p.y", "a", "b")


def _block_pairs(members: DataFrame, least: int, percent: int) -> DataFrame:
    """Rows of LISTS: pairs of different components in one bucket whose signatures agree in ``least`` places, at their
    first shared band. ``members``: what ``_mixed`` gives, with ``n`` and ``sig``.

    Members of the largest component have parts 0 .. ceil(l / PART) - 1, the others the parts after these; BLOCK / PART
    parts make a block. Two blocks, one of them of others, are a piece of work of its own.
    """
    per_block = BLOCK // PART
    parts = [F.ceil(F.col(c) / PART).cast("int") for c in ("l", "o")]
    count = [F.ceil(F.col(c) / (per_block * PART)).cast("int") for c in ("l", "o")]
    large = F.col("comp") == F.col("top")
    place = F.xxhash64("id", "bucket")
    part = F.when(large, F.pmod(place, parts[0])).otherwise(F.pmod(place, parts[1])).cast("int")
    block = F.floor(part / per_block).cast("int") + F.when(large, 0).otherwise(count[0])
    others = F.sequence(F.when(large, count[0]).otherwise(0), count[0] + count[1] - 1)
    dealt = members.withColumns({"part": part + F.when(large, 0).otherwise(parts[0]), "own": block})
    dealt = dealt.withColumn("other", F.explode(others))
    dealt = dealt.select("bucket", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "own", "part", "id", "comp", "n", "sig")
    columns = ("own", "part", "id", "comp", "n", "sig")

    def compare(run: dict) -> Iterator[tuple[int, np.ndarray]]:
        """Places of a node and of its partners."""
        bucket, x, y = run["key"]
        own, _, _, comp, n = (np.array(run[c], np.int64) for c in columns[:5])
        sig = np.frombuffer(b"".join(run["sig"]), "<u2").reshape(-1, HASHES)
        band = int(np.flatnonzero(band_keys(sig[:1])[0] == bucket)[0])
        rows = sig[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
        left, right = np.flatnonzero(own == x), np.flatnonzero(own == y)
        if x != y and len(left) > len(right):
            left, right = right, left
        for i in left.tolist():
            others = right if x != y else right[right > i]
            others = others[(comp[others] != comp[i]) & (100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i]))]
            ok = others[(sig[others] == sig[i]).sum(axis=1) >= least]
            if len(ok):  # a pair that shares an earlier band is sent from there
                ok = ok[~(rows[ok, :band] == rows[i, :band]).all(axis=2).any(axis=1)]
            if len(ok):
                yield i, ok

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}

        def close() -> Iterator[pa.RecordBatch]:
            """The pairs found, as lists by the parts of their two nodes."""
            if not held or len(held["id"]) < 2:
                return
            ids, part = np.array(held["id"], np.int64), np.array(held["part"], np.int64)
            lists: dict[tuple, dict[int, list]] = {}
            for i, partners in compare(held):
                for p in np.unique(part[partners]).tolist():
                    piece = lists.setdefault((min(p, int(part[i])), max(p, int(part[i]))), {})
                    mine = ids[partners[part[partners] == p]].tolist()
                    piece.setdefault(int(ids[i]), []).extend(mine)
                    for q in mine:  # partners that have no list of their own are needed all the same
                        piece.setdefault(q, [])
            for (x, y), piece in lists.items():
                m = len(piece)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(m, held["key"][0], np.int64)), pa.array(np.full(m, x, np.int32)), pa.array(np.full(m, y, np.int32)),
                        pa.array([*piece], pa.int64()), pa.array([*piece.values()], pa.list_(pa.int64())),
                    ],
                    names=[*PIECE, "a", "partners"],
                )

        for batch in batches:
            cols = {c: batch.column(c).to_pylist() for c in ("bucket", "x", "y", *columns)}
            for i, key in enumerate(zip(cols["bucket"], cols["x"], cols["y"], strict=True)):
                if not held or held["key"] != key:
                    yield from close()
                    held = {"key": key} | {c: [] for c in columns}
                for c in columns:
                    held[c].append(cols[c][i])
        yield from close()

    return dealt.repartition(*PIECE).sortWithinPartitions(*PIECE, "id").mapInArrow(run, LISTS)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text hash ``h``, n_shingles, node, component (a node) and component_id of every row of ``docs``."""
    with temporary(docs.sparkSession) as lasting:
        return lasting(_near_duplicates(id_and_text(docs), width, percent), "near-duplicates")


def _near_duplicates(docs: DataFrame, width: int, percent: int) -> DataFrame:
    share = percent / 100
    least = max(1, int(np.floor(HASHES * (share - 4 * np.sqrt(share * (1 - share) / HASHES)))))
    made = stored(signatures(docs, width), "signatures")
    reps = made.where("id IS NOT NULL").groupBy("id").agg(
        F.min("doc_id").alias("doc_id"), F.min("h").alias("h"), F.min("n").alias("n"), F.min("sig").alias("sig")
    )
    reps = stored(reps, "nodes")
    buckets = _bands(reps)
    sizes = buckets.groupBy("bucket").agg(F.count("*").alias("m"), F.min("id").alias("centre")).where("m > 1")
    shared = stored(buckets.join(sizes, "bucket"), "buckets")
    # from here on only nodes that share a bucket count
    near = stored(reps.join(shared.select("id").distinct(), "id"), "near-nodes")
    sets = stored(_sets(docs, near.select("id", "doc_id", "h"), width), "sets")

    def links_of(pairs: DataFrame) -> DataFrame:
        """Links among pairs of one centre a piece."""
        close = stored(_agreement(stored(pairs, "pairs"), near, least), "pairs")
        return stored(_confirmed(stored(_lists(close), "lists"), sets, percent), "links")

    # one centre for each node, then centres by bucket while they join components
    first = shared.where("centre <> id").groupBy("id").agg(F.min(F.struct("centre", "bucket", "m")).alias("c"))
    part = F.pmod(F.xxhash64("id", "c.bucket"), F.ceil(F.col("c.m") / PART)).cast("int")
    links = links_of(first.select("c.bucket", part.alias("x"), F.lit(0).alias("y"), F.col("c.centre").alias("a"), F.col("id").alias("b")))
    comp = stored(_joined(near.select("id", F.col("id").alias("comp")), links), "components")
    turn = 0
    while True:
        members = stored(_mixed(shared, comp), "members")
        left = members.where("comp <> top").agg(F.count_distinct("id")).first()[0]
        if not left:
            break
        links = links_of(_round(members, turn))
        joined = links.count()
        if joined:
            comp = stored(_joined(comp, links), "components")
        turn += 1
        if turn >= 2 and STALLED * joined < left:
            break

    # buckets that hold several components, searched whole
    members = _mixed(shared, comp).join(near.select("id", "n", "sig"), "id")
    pairs = stored(_block_pairs(members, least, percent), "pairs")
    comp = _joined(comp, stored(_confirmed(pairs, sets, percent), "links"))

    # back to documents: every node's component, every component's smallest doc_id
    of_node = reps.select("id", "doc_id").join(stored(comp, "components"), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    least_id = of_node.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    of_node = of_node.select("id", "comp").join(least_id, "comp")
    out = made.drop("sig").join(of_node, "id", "left")
    return out.select(
        "doc_id", "h", F.col("n").alias("n_shingles"), F.col("id").alias("node"), "comp",
        F.when(F.col("id").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, less all but one of each component: the smallest doc_id stays (of several rows
    with it the one with the smallest text hash, once). Rows without words all stay."""
    found = near_duplicates(docs, width, percent)
    alone = found.where("node IS NULL").select("doc_id", "h").distinct().withColumn("_once", F.lit(False))
    chosen = found.where("node IS NOT NULL AND doc_id <=> component_id").groupBy("comp").agg(
        F.first("component_id").alias("doc_id"), F.min("h").alias("h")
    )
    stay = chosen.select("doc_id", "h", F.lit(True).alias("_once")).union(alone)
    key = lambda c: [F.coalesce(c, F.lit(0)).alias("_id"), c.isNull().alias("_null")]
    stay = stay.select(*key(F.col("doc_id")), F.col("h").alias("_h"), "_once")
    # the row travels as one struct, so that no column name of ``docs`` can clash
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row"),
        *key(F.col("doc_id").cast("long")), F.xxhash64(F.col("text").cast("string")).alias("_h"),
    ).join(stay, ["_id", "_null", "_h"])
    once = rows.where("_once").dropDuplicates(["_id", "_null", "_h"])
    return once.union(rows.where("NOT _once")).select("_row.*")


def op9(docs: DataFrame) -> DataFrame:
    """Columns of the contract: four-word shingles, one row per document."""
    found = near_duplicates(docs, width=4)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
