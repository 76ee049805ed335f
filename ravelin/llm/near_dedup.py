"""Near-duplicate detection: improved consistent weighted sampling over TF-IDF shingles, banded and verified."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ravelin.llm.common import arrow_batches, arrow_rows, slices, stored, table, temp, texts_of
from ravelin.llm.components import components
from ravelin.llm.shingles import mix, shingles
from ravelin.session import broadcast_if_small

THRESHOLD = 0.8
BANDS, ROWS = 12, 4
#: Document frequencies are kept for 2 ** SLOT_BITS hashes of shingles: one size for any corpus, so they can be broadcast.
SLOT_BITS = 18
#: Weights fall once a shingle lies in a sizeable share of all documents; below it they hardly differ, so that a large
#: group of near copies does not lose the shingles it shares.
COMMON_SHARE = 0.1
#: Members of a bucket are compared with its leader and with this many members before them.
BEFORE = 2
#: Members that one leader's text is compared with in one place.
CHUNK = 128
#: Slots of a text's outline, and the sides of the cells in which texts of one bucket meet.
OUTLINE, CELL_STRAYS, CELL_MEMBERS = 128, 64, 1_024
TABLE_BITS = 15
#: Rows, most of them texts or bags of shingles, that go to Python at a time.
BATCH_ROWS = 512

_SLOT = np.uint64(64 - SLOT_BITS)


def node_of(text: Column) -> Column:
    """What stands for a text: equal texts are one node."""
    return F.unhex(F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary")))


def _counted(hashes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct shingles, ascending, how often each occurs, and the number of distinct ones."""
    ends = np.cumsum(sizes)
    found = [np.unique(hashes[e - n : e], return_counts=True) for e, n in zip(ends, sizes, strict=True)]
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), np.array([len(f[0]) for f in found], dtype=np.int64)


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, rows = np.zeros(1 << SLOT_BITS, dtype=np.int64), 0
    for part in slices(batches):
        distinct, _, _ = _counted(*shingles(texts_of(part)))
        counts += np.bincount((distinct >> _SLOT).astype(np.int64), minlength=1 << SLOT_BITS)
        rows += part.num_rows
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(counts[used], rows))], names=["slot", "n"])


def shingle_weights(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of each slot over all documents, damped: 2 ** SLOT_BITS numbers."""
    counted = docs.select("text").mapInArrow(_count_slots, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    total = max(1, int(counted.loc[counted["slot"] < 0, "n"].sum()))
    share = np.zeros(1 << SLOT_BITS)
    own = counted[counted["slot"] >= 0]
    share[own["slot"].to_numpy()] = np.minimum(1.0, own["n"] / total)
    return np.sqrt(np.log1p(1.0 / (share + COMMON_SHARE))).astype(np.float32)


def _weighted(texts: list[str], idf: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles, their weights (damped term frequency by inverse document frequency; all 1 without idf), and their number."""
    distinct, counts, sizes = _counted(*shingles(texts))
    if idf is None:
        return distinct, np.ones(len(distinct), np.float32), sizes
    return distinct, (1.0 + np.log(np.maximum(counts, 1))) * idf[(distinct >> _SLOT).astype(np.int64)], sizes


def _variates() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each hash value of a table: r and ln c of two gamma(2, 1) variates, and a uniform one; and a multiplier for each sample."""
    random = np.random.Generator(np.random.PCG64(29))
    r = random.gamma(2.0, 1.0, 1 << TABLE_BITS).astype(np.float32)
    c = np.log(random.gamma(2.0, 1.0, 1 << TABLE_BITS)).astype(np.float32)
    return r, c, random.random(1 << TABLE_BITS).astype(np.float32), random.integers(1 << 62, size=BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def outline(text: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A text's weights added up in OUTLINE slots of its shingles."""
    return np.bincount((mix(text[0]) % np.uint64(OUTLINE)).astype(np.int64), weights=text[1], minlength=OUTLINE)


def signatures(texts: list[str], idf: np.ndarray) -> np.ndarray:
    """A row of BANDS hashes for each text, each of ROWS weighted samples. Texts without words get zeros.

    Sample k of a text is the shingle S with the least ln a = ln c - r (t - beta + 1), t = floor(ln w / r + beta), where
    r, c and beta hang on S and k only; two texts draw the same (S, t) with the probability of their weighted Jaccard
    similarity.
    """
    r, c, beta, multipliers = _variates()
    hashes, weights, sizes = _weighted(texts, idf)
    out = np.zeros((len(texts), BANDS), dtype=np.uint64)
    filled = np.flatnonzero(sizes)
    if not len(filled):
        return out
    starts = (np.cumsum(sizes) - sizes)[filled]
    logs, low = np.log(weights).astype(np.float32), (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    shift, samples = np.uint64(64 - TABLE_BITS), []
    for k in range(BANDS * ROWS):
        with np.errstate(over="ignore"):
            at = ((hashes * multipliers[k]) >> shift).astype(np.int32)
            rate, offset = r[at], beta[at]
            step = np.floor(logs / rate + offset)
            value = c[at] - rate * (step - offset + np.float32(1))
            bits = value.view(np.uint32)
            ordered = np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31))
            drawn = low ^ (step.astype(np.int32).view(np.uint32) * np.uint32(0x9E3779B1))
            least = np.minimum.reduceat((ordered.astype(np.uint64) << np.uint64(32)) | drawn, starts)
        samples.append(least & np.uint64(0xFFFFFFFF))
    with np.errstate(over="ignore"):
        for band in range(BANDS):
            key = np.full(len(filled), band + 1, dtype=np.uint64)
            for row in range(ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + samples[band * ROWS + row])
            out[filled, band] = key
    return out


def _sign(shared):
    out = pa.schema([("doc_id", pa.int64()), ("node", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            bands = signatures(texts_of(part), shared.value).astype(np.int64)
            rows = [b.tolist() if b.any() else [] for b in bands]
            yield arrow_batches({"doc_id": part.column("doc_id"), "node": part.column("node"), "bands": rows}, out)

    return run


_PAIRS = pa.schema([("band", pa.int32()), ("key", pa.int64()), ("a", pa.binary()), ("a_id", pa.int64()), ("b", pa.binary()), ("b_id", pa.int64()), ("chunk", pa.int64())])
_PAIRS_SQL = "band int, key long, a binary, a_id long, b binary, b_id long, chunk long"


def _pair_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each member of a bucket with the bucket's first member and those just before it; buckets come sorted.

    A row without b names the bucket that a task begins or ends with, and its first member there: that bucket may go on
    in another task.
    """
    at, leader, before, place, first = None, None, [], 0, True
    for batch in batches:
        rows: dict[str, list] = {f.name: [] for f in _PAIRS}

        def give(band, key, a, b, chunk, rows=rows):
            for name, value in zip(rows, (band, key, a[0], a[1], b[0], b[1], chunk), strict=True):
                rows[name].append(value)

        bands, keys = batch.column("band").to_numpy(), batch.column("key").to_numpy()
        if not len(keys):
            continue
        follows = np.concatenate([[True], (bands[1:] == bands[:-1]) & (keys[1:] == keys[:-1])])
        wanted = np.flatnonzero(follows | np.concatenate([follows[1:], [True]]))  # the rest are alone in their bucket
        nodes, ids = batch.column("node"), batch.column("doc_id")
        for k in wanted.tolist():
            where, member = (bands[k], keys[k]), (nodes[k].as_py(), ids[k].as_py())
            if where != at:
                at, leader, before, place = where, member, [], 0
                if first:
                    give(*at, leader, (None, None), 0)
            else:
                place += 1
                for other in {leader[0]: leader, **{x[0]: x for x in before}}.values():
                    give(*at, other, member, place // CHUNK)
            first = False
            before = [*before, member][-BEFORE:]
        yield arrow_batches(rows, _PAIRS)
    if at is not None:
        yield arrow_batches(dict(zip((f.name for f in _PAIRS), ([at[0]], [at[1]], [leader[0]], [leader[1]], [None], [None], [0]), strict=True)), _PAIRS)


def candidate_pairs(signed: DataFrame) -> DataFrame:
    """Distinct (a, a_id, b, b_id, chunk) to verify: within each bucket of a band, members with its leader and the ones before.

    A bucket of m texts gives at most (1 + BEFORE) m pairs, and a chain of them joins all its members. Buckets are
    range-sorted, so a bucket of any size spreads over tasks; the pieces' leaders are paired in turn.
    """
    texts = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    members = texts.select("node", "doc_id", F.posexplode("bands").alias("band", "key"))
    paired = stored(members.repartitionByRange("band", "key", "node").sortWithinPartitions("band", "key", "node").mapInArrow(_pair_up, _PAIRS_SQL), "pairs")
    pieces = paired.where("b is null").select("band", "key", F.struct("a", "a_id").alias("piece")).distinct()  # two for each task
    least = pieces.groupBy("band", "key").agg(F.min("piece").alias("least"))
    across = pieces.join(least, ["band", "key"]).where("piece.a != least.a").select("least.a", "least.a_id", F.col("piece.a").alias("b"), F.col("piece.a_id").alias("b_id"), F.lit(0).cast("long").alias("chunk"))
    every = paired.where("b is not null").select("a", "a_id", "b", "b_id", "chunk").unionAll(across)
    return every.groupBy("a", "b").agg(F.min("a_id").alias("a_id"), F.min("b_id").alias("b_id"), F.min("chunk").alias("chunk"))


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the lesser weights over sum of the greater ones; texts as ascending shingles and their weights."""
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = np.minimum(a[1][at_a], b[1][at_b]).sum()
    every = a[1].sum() + b[1].sum() - shared
    return float(shared / every) if every else 1.0


def _verify(shared, threshold: float):
    out = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("similarity", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, group, leader = shared.value, None, None
        for part in slices(batches, 64):
            found: dict[str, list] = {f.name: [] for f in out}
            hashes, weights, sizes = _weighted(texts_of(part), idf)
            ends = np.cumsum(sizes)
            a, chunk, node, role = (part.column(c).to_pylist() for c in ("a", "chunk", "node", "role"))
            for k in range(part.num_rows):
                own = hashes[ends[k] - sizes[k] : ends[k]], weights[ends[k] - sizes[k] : ends[k]]
                if role[k] == 0:
                    group, leader = (a[k], chunk[k]), own
                elif group == (a[k], chunk[k]) and (similarity := weighted_jaccard(leader, own)) >= threshold:
                    for name, value in zip(found, (a[k], node[k], similarity), strict=True):
                        found[name].append(value)
            yield arrow_batches(found, out)

    return run


def verified_links(rows: DataFrame, pairs: DataFrame, shared, threshold: float = THRESHOLD) -> DataFrame:
    """The pairs whose texts reach the threshold, with their similarity.

    A leader's text meets at most CHUNK members' texts in one place; each text is read from one of its rows.
    """
    needs = pairs.select(F.col("b").alias("node"), F.col("b_id").alias("row_id"), "a", "chunk", F.lit(1).alias("role"))
    needs = needs.unionAll(pairs.select(F.col("a").alias("node"), F.col("a_id").alias("row_id"), "a", "chunk", F.lit(0).alias("role")).distinct())
    asked = broadcast_if_small(needs.select(F.col("node").alias("asked"), "row_id").distinct())  # beyond the bound by shuffle
    few = rows.join(asked, (F.col("node") == F.col("asked")) & F.col("doc_id").eqNullSafe(F.col("row_id")), "left_semi")  # the other texts stay where they are
    texts = few.join(needs, (few["node"] == needs["node"]) & few["doc_id"].eqNullSafe(needs["row_id"])).select("a", "chunk", "role", needs["node"], "text")
    return texts.repartition("a", "chunk").sortWithinPartitions("a", "chunk", "role", "node").mapInArrow(_verify(shared, threshold), "a binary, b binary, similarity double")


def upper(mark: np.ndarray) -> np.ndarray:
    """An outline in 16 bits a slot, never below its true values (infinite beyond what 16 bits hold)."""
    with np.errstate(over="ignore"):
        near = mark.astype("<f2")
        return np.where(near < mark, np.nextafter(near, np.float16(np.inf)), near).astype("<f2")


def _bags(shared):
    """Each text's distinct shingles (64 bits each), their weights (32 bits each), its outline and the sum of its weights."""
    out = pa.schema([("node", pa.binary()), ("hashes", pa.binary()), ("weights", pa.binary()), ("outline", pa.binary()), ("total", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 64):
            hashes, weights, sizes = _weighted(texts_of(part), shared.value)
            spans = [(end - size, end) for end, size in zip(np.cumsum(sizes).tolist(), sizes.tolist(), strict=True)]
            bags = {"hashes": [hashes[x:y].astype("<u8").tobytes() for x, y in spans], "weights": [weights[x:y].astype("<f4").tobytes() for x, y in spans]}
            marks = [outline((hashes[x:y], weights[x:y])) for x, y in spans]
            yield arrow_batches({"node": part.column("node"), **bags, "outline": [upper(m).tobytes() for m in marks], "total": [m.sum() for m in marks]}, out)

    return run


_CELL = pa.schema(
    [("band", pa.int32()), ("key", pa.int64()), ("i", pa.int64()), ("j", pa.int64()), ("stray", pa.int32()), ("node", pa.binary()), ("root", pa.binary())]
    + [("main", pa.bool_()), ("bands", pa.list_(pa.int64()))]
)
_CELL_SQL = "band int, key long, i long, j long, stray int, node binary, root binary, main boolean, bands array<long>"


def _may_meet(threshold: float):
    """The rows of each cell that have a partner there by their outlines: only their shingles are sent for.

    What two texts share is at most the sum of the lesser of their outlines' slots, and more shared weight means more
    similarity, so no pair that reaches the threshold is passed over. Cells come sorted, strays before members.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, strays, held, met = None, [], None, None
        for part in slices(batches):
            found: list[dict] = []
            for row in part.to_pylist():
                where = row["band"], row["key"], row["i"], row["j"]
                if where != cell:
                    found += [strays[k] for k in np.flatnonzero(met).tolist()] if met is not None else []
                    cell, strays, held, met = where, [], None, None
                if row["stray"] == 0:
                    strays.append(row)
                    continue
                if not strays:
                    continue
                if held is None:
                    held = np.stack([np.frombuffer(x["outline"], "<f2") for x in strays]).astype(np.float32), np.array([x["total"] for x in strays]), np.array([x["bands"] for x in strays])
                    met = np.zeros(len(strays), dtype=bool)
                shared = np.minimum(held[0], np.frombuffer(row["outline"], "<f2").astype(np.float32)).sum(axis=1, dtype=np.float64)
                near = shared * (1 + threshold) >= threshold * (1 - 1e-6) * (held[1] + row["total"])
                near &= ~(held[2][:, : row["band"]] == np.array(row["bands"])[: row["band"]]).any(axis=1)
                partners = [k for k in np.flatnonzero(near).tolist() if strays[k]["root"] != row["root"] and (row["main"] or strays[k]["node"] < row["node"])]
                if partners:
                    met[partners] = True
                    found.append(row)
            yield arrow_batches({f.name: [x[f.name] for x in found] for f in _CELL}, _CELL)
        if met is not None and met.any():
            yield arrow_batches({f.name: [strays[k][f.name] for k in np.flatnonzero(met).tolist()] for f in _CELL}, _CELL)

    return run


def _meet(threshold: float):
    """In each cell the strays are held and the members pass by; a link comes out where two components first meet.

    Outlines rule out most pairs as in _may_meet. Texts that share an earlier band meet there.
    """
    out = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, strays, held, joined = None, [], None, set()
        for part in slices(batches, 64):
            found: dict[str, list] = {f.name: [] for f in out}
            for row in part.to_pylist():
                where = row["band"], row["key"], row["i"], row["j"]
                if where != cell:
                    cell, strays, held, joined = where, [], None, set()
                bag = np.frombuffer(row["hashes"], "<u8"), np.frombuffer(row["weights"], "<f4")
                mark, bands = outline(bag), np.array(row["bands"])
                if row["stray"] == 0:
                    strays.append((row["node"], row["root"], bag, mark, bands))
                    continue
                if not strays:
                    continue
                if held is None:
                    held = np.stack([x[3] for x in strays]), np.array([x[3].sum() for x in strays]), np.stack([x[4] for x in strays])
                shared = np.minimum(held[0], mark).sum(axis=1)
                near = shared >= threshold * (1 - 1e-6) * (held[1] + mark.sum() - shared)
                for at in np.flatnonzero(near & ~(held[2][:, : row["band"]] == bands[: row["band"]]).any(axis=1)).tolist():
                    node, root, other, _, _ = strays[at]
                    if root == row["root"] or (root, row["root"]) in joined or not (row["main"] or node < row["node"]):
                        continue
                    if weighted_jaccard(other, bag) >= threshold:
                        joined.add((root, row["root"]))
                        found["a"].append(root)
                        found["b"].append(row["root"])
            yield arrow_batches(found, out)

    return run


def stray_links(rows: DataFrame, signed: DataFrame, roots: DataFrame, shared, threshold: float = THRESHOLD) -> DataFrame:
    """Links (a, b) between the roots of components that texts of one bucket join.

    Of each bucket with several components, the members outside the largest are strays; they meet all its members in a
    grid of cells of bounded sides: first by their outlines, then those with a possible partner in a cell by their
    shingles. At most one link of two components comes out of a cell. Of buckets with the same
    members (by number, least, greatest and sum of hashes) the one of the first band stands for all.
    """
    texts = signed.groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands"))
    spot = F.xxhash64("node")
    members = texts.join(roots, "node", "left").select("node", "doc_id", F.coalesce("root", "node").alias("root"), F.posexplode("bands").alias("band", "key"))
    apart = members.groupBy("band", "key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("band", "key")
    members = stored(members.join(broadcast_if_small(apart), ["band", "key"]), "mixed")  # of buckets with several components only
    counted = members.groupBy("band", "key", "root").agg(F.count("*").alias("n"), F.min("node").alias("low"), F.max("node").alias("high"), F.sum(spot.cast("decimal(38,0)")).alias("mark")).groupBy("band", "key")
    several = counted.agg(F.sum("n").alias("n"), F.max("n").alias("top"), F.max_by("root", F.struct("n", "root")).alias("largest"), F.min("low").alias("low"), F.max("high").alias("high"), F.sum("mark").alias("mark"))
    mixed = several.groupBy("n", "low", "high", "mark").agg(F.min_by(F.struct(*several.columns), F.struct("band", "key")).alias("one")).select("one.*")
    sides = F.ceil((F.col("n") - F.col("top")) / CELL_STRAYS).alias("is"), F.ceil(F.col("n") / CELL_MEMBERS).alias("js")
    met = members.join(mixed.select("band", "key", "largest", *sides), ["band", "key"]).withColumn("main", F.col("root") == F.col("largest"))
    met = stored(met.join(texts.select("node", "bands"), "node"), "met")
    needs = broadcast_if_small(met.select("node", F.col("doc_id").alias("row_id")).distinct())  # two ids a row; beyond the bound by shuffle
    bags = rows.join(needs, "node").where(F.col("doc_id").eqNullSafe(F.col("row_id"))).select("node", "text").mapInArrow(_bags(shared), "node binary, hashes binary, weights binary, outline binary, total double")
    bags = stored(bags, "bags")
    outlined = met.join(bags.select("node", "outline", "total").dropDuplicates(["node"]), "node")
    every = lambda side: F.explode(F.sequence(F.lit(0).cast("long"), F.col(side) - 1))
    strays = outlined.where("not main").withColumns({"i": F.pmod(spot, "is"), "j": every("js"), "stray": F.lit(0)})
    passing = outlined.withColumns({"i": every("is"), "j": F.pmod(spot, "js"), "stray": F.lit(1)})
    kept = (*_CELL.names, "outline", "total")
    cells = strays.select(*kept).unionAll(passing.select(*kept)).repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j", "stray")
    left = stored(cells.mapInArrow(_may_meet(threshold), _CELL_SQL), "partners")
    few = bags.select("node", "hashes", "weights").join(broadcast_if_small(left.select("node").distinct()), "node", "left_semi").dropDuplicates(["node"])
    cells = left.join(few, "node").repartition("band", "key", "i", "j").sortWithinPartitions("band", "key", "i", "j", "stray")
    return cells.mapInArrow(_meet(threshold), "a binary, b binary")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, node, class_id) of every row: rows of one class are joined by a chain of near copies.

    Texts are bags of five-word shingles weighted by term frequency and inverse document frequency over all documents.
    Equal texts are one node from the start. Consistent weighted samples of each distinct text are banded; texts that
    share a band are candidates, and those whose weighted Jaccard similarity reaches the threshold are linked. A bucket's
    members are first compared with its first member and the two before; members that this leaves in different components
    then meet in cells, so no link between texts that share a band is lost to a class. A class's id is its least doc_id,
    null only where all its ids are.

    Null text counts as empty; texts without words are alike only if equal. Repeated rows and ids each give a row.
    Other columns are left out; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).withColumn("node", node_of(F.col("text")))
    with arrow_rows(docs.sparkSession, BATCH_ROWS):  # every job that hands texts to Python runs in here
        shared = docs.sparkSession.sparkContext.broadcast(shingle_weights(rows))
        signed = stored(rows.mapInArrow(_sign(shared), "doc_id long, node binary, bands array<long>"), "signatures")
        pairs = stored(candidate_pairs(signed), "candidates")
        roots = components(verified_links(rows, pairs, shared, threshold))
        last = components(stray_links(rows, signed, roots, shared, threshold)).select(F.col("node").alias("first_root"), F.col("root").alias("last_root"))
    placed = signed.select("doc_id", "node").join(roots, "node", "left").withColumn("first_root", F.coalesce("root", "node"))
    placed = placed.join(last, "first_root", "left").select("doc_id", "node", F.coalesce("last_root", "first_root").alias("root"))
    return placed.join(placed.groupBy("root").agg(F.min("doc_id").alias("class_id")), "root").select("doc_id", "node", "class_id")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with one row of each class of near copies: the one of the least id, then of the least text hash."""
    node, kept_id, kept_node = temp("node"), temp("kept_id"), temp("kept_node")
    classes = near_duplicates(docs, threshold)
    kept = classes.groupBy("class_id", F.when(F.col("class_id").isNull(), F.col("node")).alias("own")).agg(F.min(F.struct(F.col("doc_id"), F.col("node"))).alias("kept"))
    kept = kept.select(F.col("kept.doc_id").alias(kept_id), F.col("kept.node").alias(kept_node))
    rows = docs.withColumn(node, node_of(F.col("text")))
    chosen = rows.join(kept, (F.col(node) == F.col(kept_node)) & F.col("doc_id").eqNullSafe(F.col(kept_id))).drop(kept_id, kept_node)
    return chosen.dropDuplicates([node]).drop(node)


def query(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near copies of every document, and whether the document stays."""
    classes = near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))
    return classes.select("doc_id", "class_id", (F.col("doc_id") == F.col("class_id")).alias("stays"))
