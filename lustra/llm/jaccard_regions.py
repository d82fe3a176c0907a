"""Near-duplicate documents: an exact join on the Jaccard distance of word shingles.

The distance 1 - |x n y| / |x u y| is a metric, so pivots split the documents into
regions and the triangle inequality says which of them another region also needs.

* Equal sets are one point, carried by its smallest document.
* The first pivots are sets of one shingle. A document is equally near to all of its
  own shingles and at distance 1 from any other pivot, so a fixed order (rare first)
  breaks the tie, and a document is repeated in every region that a partner's may
  be: those of the first n - ceil(0.75 n) + 1 shingles. Of two documents that link, these
  always have one in common. A sketch of all shingles comes first: who has under 75 %
  of shingles that occur twice can't link and goes to no region. Its counts give the order.
  A sketch too full to tell lets more through; so a region is known only once its shingle, sent to
  its owner by hash, was met with two texts there.
* First every region's least member is its one pivot, which joins most copies into components. A pair is
  measured only if the places of the region's shingle in both orders leave room for a link.
* A region still open first loses the members whose size and place leave no room for a link with any other.
* Inside a region still open the pivots are documents. Each member measures its distance to
  every pivot and is linked with it up to 0.25. Links join components, and two members
  of one component need no comparison: only pairs with a member outside the region's
  largest component are still open. Those outside form the Voronoi regions of their
  nearest pivots; with them go all members that the triangle inequality lets link with
  one of them: at most 0.25 farther from the pivot. Who is linked with the pivot goes only if
  a member beyond 0.25 lies at most 0.25 farther. These regions are split again likewise.
* A region is done when its members are in one component. With few pairs still open
  those with room for a link are compared one by one; else there are sixteen times the pivots at the next level.

Pivots leave their region, so every level shrinks it. Distances always are of the
whole sets, made of the texts anew for those in a pair, and nothing is sampled. A group of copies costs one distance for each member
and pivot, not one for each pair.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lustra.llm.components import connected_components
from lustra.llm.memory import returning, settle
from lustra.llm.repeats import LAST, id_of, keyed, repeats_ids
from lustra.llm.sketch import Seen, seen_twice, sketch_width
from lustra.llm.stored import stored
from lustra.llm.symbols import Chunk, Runs, chunks, mixed, run_starts

U64 = np.uint64
_SETS = "doc long, rid long, n long, f1 long, f2 long, may boolean"
_SHINGLES = "doc long, rid long, toks array<long>"
_PLACED = "block long, settled boolean, regions binary, docs binary, rids binary, sizes binary, places binary"
_MEMBERS = "region long, doc long, rid long, n long, at long"
#: Rows of a region that a task settles by itself or sends on, gathered so many at a time; a block gets about as many in all.
_GATHERED = 1 << 19


def _shingle_sets(chunk: Chunk, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of each text."""
    starts, ends, doc = chunk.words()
    words = chunk.word_values(starts, ends, lower=True)
    runs = Runs(words, 1)
    every = runs.every(width)
    bounds = np.searchsorted(doc, np.arange(len(chunk) + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= width:
            yield np.unique(every[a : b - width + 1])
        elif b > a:
            yield runs.of(np.array([a]), b - a)
        else:
            yield np.empty(0, U64)


def _shingles(width: int):
    def of(batches):
        for batch in batches:
            for chunk in chunks(batch.column("text"), 1 << 18):
                yield np.concatenate(list(_shingle_sets(chunk, width)))

    return of


def _sets(width: int, percent: int, seen: Seen):
    """Each text's set size and identity, and whether it may have a partner."""

    def of(batches):
        for batch in batches:
            for chunk in chunks(batch.column("text"), 1 << 18):
                n, f1, f2 = [], [], []
                sets = list(_shingle_sets(chunk, width))
                sizes = np.array([len(s) for s in sets])
                often = _often(np.concatenate(sets), sizes, seen)[1]
                for own in sets:
                    n.append(len(own))
                    f1.append(int(mixed(own).sum(dtype=U64).view(np.int64)))
                    f2.append(int(mixed(own ^ U64(0x5851F42D4C957F2D)).sum(dtype=U64).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(chunk.first, len(chunk)) for c in ("doc", "rid")),
                        *(pa.array(c, pa.int64()) for c in (n, f1, f2)),
                        pa.array((sizes > 0) & (100 * often >= percent * sizes)),
                    ],
                    names=["doc", "rid", "n", "f1", "f2", "may"],
                )

    return returning(of)


def _often(flat: np.ndarray, sizes: np.ndarray, seen: Seen) -> tuple[np.ndarray, np.ndarray]:
    """Of the shingles of sets of these sizes which were seen twice, and how many of each set."""
    twice = seen.twice(flat)
    ends = np.cumsum(sizes)
    counts = np.r_[0, np.cumsum(twice)]
    return twice, counts[ends] - counts[ends - sizes]


def _names(doc: np.ndarray, rid: np.ndarray) -> np.ndarray:
    """What stands for a text in a bit map."""
    return mixed(mixed(doc.astype(U64)) ^ mixed(rid.astype(U64) + U64(1)) * U64(3))


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "rid"))


def _names_twice(batches):
    """The names of texts, each twice, so that a sketch shows it as seen twice."""
    for batch in batches:
        names = _names(*_ids(batch))
        yield np.concatenate([names, names])


def _bit_map(texts: DataFrame, rows: int) -> Seen:
    """True for each of the texts (doc, rid), of which there are so many, and for about one in sixteen others."""
    return seen_twice([(texts, _names_twice)], sketch_width(rows, load=1 / 16))


def _named_sets(batches, width: int, names: Seen):
    """The ids and the shingle sets of the texts that the bit map names, a part of a batch at a time."""
    for batch in batches:
        batch = batch.filter(pa.array(names.twice(_names(*_ids(batch)))))
        doc, rid = _ids(batch)
        for chunk in chunks(batch.column("text"), 1 << 18):
            at = slice(chunk.first, chunk.first + len(chunk))
            yield doc[at], rid[at], list(_shingle_sets(chunk, width))


def _shingles_of(width: int, names: Seen):
    """The sets themselves."""

    def of(batches):
        for doc, rid, sets in _named_sets(batches, width, names):
            ends = np.cumsum([0, *map(len, sets)])
            toks = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(doc), pa.array(rid), toks], names=["doc", "rid", "toks"])

    return returning(of)


def _by_block(columns: list[np.ndarray], block: np.ndarray, settled: bool) -> pa.RecordBatch:
    """A row for each block, with the bytes of its part of each column."""
    order = np.argsort(block, kind="stable")
    block = block[order]
    starts = np.flatnonzero(run_starts(block))
    bounds = list(zip(starts.tolist(), np.r_[starts[1:], len(block)].tolist()))
    parts = [[c[a:b].tobytes() for a, b in bounds] for c in (column[order] for column in columns)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(block[starts].astype(np.int64)),
            pa.array(np.full(len(starts), settled)),
            *(pa.array(p, pa.binary()) for p in parts),
        ],
        names=[c.split()[0] for c in _PLACED.split(", ")],
    )


_KINDS = (U64, np.int64, np.int64, np.int32, np.int32)
#: The place of a row that only says that a task has met the shingle twice.
_MARK = -1


def _prefixes(width: int, percent: int, seen: Seen, names: Seen, blocks: int):
    """Rows (shingle, text, set size, the shingle's place) for the shingles of the prefix that were seen twice, by block.

    What a task meets twice is settled: these rows go anywhere, and one mark to the shingle's block. So a block
    gets a row or a mark of each shingle from each portion of a task, however many texts share it.
    """
    bits = U64(64 - blocks.bit_length() + 1)

    def portion(held):
        regions, docs, rids, sizes, places = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((rids, docs, regions))
        first = run_starts(regions[order], docs[order], rids[order])
        regions, docs, rids, sizes, places = (x[order][first] for x in (regions, docs, rids, sizes, places))
        starts = run_starts(regions)
        met = np.diff(np.r_[np.flatnonzero(starts), len(regions)])[np.cumsum(starts) - 1] > 1
        anywhere = (mixed(docs.astype(U64)) >> bits) % U64(blocks)
        rows = [regions, docs, rids, sizes.astype(np.int32), places.astype(np.int32)]
        yield _by_block([c[met] for c in rows], anywhere[met], True)
        rows[4] = np.where(met, np.int32(_MARK), rows[4])
        sent = ~met | starts
        rows = [c[sent] for c in rows]
        yield _by_block(rows, (rows[0] >> bits) % U64(blocks), False)

    def of(batches):
        held, size = [], 0
        for doc, rid, sets in _named_sets(batches, width, names):
            sizes = np.array([len(s) for s in sets])
            flat = np.concatenate(sets)
            twice, often = _often(flat, sizes, seen)
            weight = np.where(twice, seen.level(flat), 0)
            ends = np.cumsum(sizes)
            for i in np.flatnonzero((sizes > 0) & (100 * often >= percent * sizes)).tolist():
                n, own = int(sizes[i]), slice(ends[i] - sizes[i], ends[i])
                prefix = n - (percent * n + 99) // 100 + 1
                order = np.lexsort((flat[own], weight[own]))[:prefix]
                place = np.flatnonzero(twice[own][order])
                k = len(place)
                held.append((flat[own][order[place]], *(np.full(k, x, np.int64) for x in (doc[i], rid[i], n)), place))
                size += k
                if size >= _GATHERED:
                    yield from portion(held)
                    held, size = [], 0
        if size:
            yield from portion(held)

    return returning(of)


def _members():
    """Of shingles that several texts have in their prefixes: rows (region, doc, rid, n, at). Rows come sorted by block."""

    def batch_of(columns):
        return pa.RecordBatch.from_arrays(
            [pa.array(c.view(np.int64) if c.dtype == U64 else c.astype(np.int64)) for c in columns],
            names=["region", "doc", "rid", "n", "at"],
        )

    def met(held):
        columns = [np.concatenate(x) for x in zip(*held)]
        order = np.argsort(columns[0], kind="stable")
        starts = run_starts(columns[0][order])
        several = np.diff(np.r_[np.flatnonzero(starts), len(order)])[np.cumsum(starts) - 1] > 1
        kept = order[several]
        kept = kept[columns[4][kept] != _MARK]
        return batch_of([c[kept] for c in columns])

    def of(batches):
        now, held = None, []
        for batch in batches:
            for block, settled, *parts in zip(*(column.to_pylist() for column in batch.columns)):
                columns = [np.frombuffer(p, kind) for p, kind in zip(parts, _KINDS)]
                if settled:
                    yield batch_of(columns)
                    continue
                if block != now and held:
                    yield met(held)
                    held = []
                now = block
                held.append(columns)
        if held:
            yield met(held)

    return returning(of)


def _may_link(percent: int, n: Column, at: Column, m: Column, place: Column) -> Column:
    """Whether sets of ``n`` and ``m`` shingles can link if the first they share stands at these places.

    Both sets are in one order, so at most the shingles from there on are shared.
    """
    return (100 + percent) * F.least(n - at, m - place) >= percent * (n + m)


#: The sets (doc, rid, toks) of some texts (doc, rid), of which there are so many, and a function to call once they were read.
SetsOf = Callable[[DataFrame, int], tuple[DataFrame, Callable[[], None]]]


def _distances(pairs: DataFrame, sets_of: SetsOf) -> DataFrame:
    """``x``, ``y`` (structs doc, rid), ``shared`` and ``both``: sizes of intersection and union. Stored.

    Only sets that are in a pair are made.
    """
    pairs = stored(pairs, "pairs")
    named = pairs.select("x.doc", "x.rid").unionByName(pairs.select("y.doc", "y.rid")).distinct()
    named = stored(named, "named")
    sets, release = sets_of(named, named.count())
    shared = F.size(F.array_intersect("xt", "yt"))
    # both joins read the sets by doc and rid, so that they are shuffled once
    joined = pairs.select("x", "y", "x.doc", "x.rid").join(sets, ["doc", "rid"])
    joined = joined.select("x", "y", F.col("toks").alias("xt"), "y.doc", "y.rid").join(sets, ["doc", "rid"])
    joined = joined.withColumnRenamed("toks", "yt")
    both = F.size("xt") + F.size("yt") - shared
    known = stored(joined.select("x", "y", shared.alias("shared"), both.alias("both")), "distances")
    release()
    settle(known.sparkSession)
    return known


def _open_regions(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of regions with more than one component; ``minor``: not of the region's largest component.

    Of regions with the very same members the one whose shingle comes first is kept: there
    each member has its least place.
    """
    joined = members.join(labels, members.doc == labels.node, "left")
    placed = joined.withColumn("label", F.coalesce("component", "doc")).drop("node", "component")
    name = F.xxhash64("doc", "rid")
    parts = placed.groupBy("region", "label").agg(
        F.count("*").alias("n"),
        F.bit_xor(name).alias("f1"),
        F.sum(name.cast("decimal(38,0)")).alias("f2"),
        F.sum("at").alias("at"),
    )
    sizes = parts.groupBy("region").agg(
        F.sum("n").alias("size"),
        F.max(F.struct("n", (-F.col("label")).alias("at"))).alias("largest"),
        F.bit_xor("f1").alias("f1"),
        F.sum("f2").alias("f2"),
        F.sum("at").alias("at"),
    )
    sizes = sizes.withColumn("minors", F.col("size") - F.col("largest.n")).filter("minors > 0")
    sizes = sizes.groupBy("size", "f1", "f2").agg(F.min(F.struct("at", "region", "minors", "largest")).alias("one"))
    kept = sizes.select("one.region", "one.minors", "size", (-F.col("one.largest.at")).alias("major"))
    return placed.join(kept, "region").withColumn("minor", F.col("label") != F.col("major")).drop("major")


def _with_partner(placed: DataFrame, percent: int) -> DataFrame:
    """Members of open regions that have room for a link with a member of their region, one of both a minor.

    A set of ``n`` with the shingle at place ``at`` links with sets of at most ``most`` only. So its
    partner is no larger than its ``most``, and has a ``most`` of its own size or more: a running maximum
    over the region's kinds (size, place, minor), of which there are few however many members it has.
    """
    kind = ["region", "n", "at", "minor"]
    most = F.floor((100 * F.col("n") - (100 + percent) * F.col("at")) / percent)
    kinds = placed.select(*kind).distinct().withColumn("most", most)
    gives = kinds.withColumn("upto", F.col("n")).withColumn("asks", F.lit(False))
    # a minor with room for its own size finds itself, so it needn't ask
    asks = kinds.filter(~F.col("minor") | (F.col("most") < F.col("n")))
    asks = asks.withColumn("upto", F.col("most")).withColumn("asks", F.lit(True))
    before = W.partitionBy("region").orderBy("upto", "asks").rowsBetween(W.unboundedPreceding, W.currentRow)
    given = F.when(~F.col("asks"), F.col("most"))
    best = F.when(F.col("minor"), F.max(given).over(before)).otherwise(
        F.max(F.when(F.col("minor"), given)).over(before)
    )
    found = gives.unionByName(asks).withColumn("best", best)
    alone = found.filter(F.col("asks") & (F.coalesce("best", F.lit(-1)) < F.col("n"))).select(*kind)
    return placed.join(alone, kind, "left_anti")


def _links(known: DataFrame, percent: int) -> DataFrame:
    found = known.filter(100 * F.col("shared") >= percent * F.col("both"))
    return found.select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"))


def _first_links(sets_of: SetsOf, members: DataFrame, percent: int) -> DataFrame:
    """Components by the links of every region's least member with the others."""
    heads = members.groupBy("region").agg(
        F.min(F.struct("doc", "rid", "n", "at")).alias("head"), F.count("*").alias("size")
    )
    pairs = members.join(heads.filter("size > 1").drop("size"), "region")
    x, y = F.struct("doc", "rid"), F.struct("head.doc", "head.rid")
    pairs = pairs.filter((x != y) & _may_link(percent, *map(F.col, ("n", "at", "head.n", "head.at"))))
    pairs = pairs.select(F.least(x, y).alias("x"), F.greatest(x, y).alias("y")).distinct()
    return connected_components(_links(_distances(pairs, sets_of), percent))


def near_duplicate_links(sets_of: SetsOf, members: DataFrame, percent: int = 75, leaf: int = 1 << 18) -> DataFrame:
    """``node`` and ``component`` (doc_ids) of all documents that link with another.

    ``sets_of`` gives one row for each set that is asked for: doc, rid, toks. ``members`` has region,
    doc, rid, the set's size ``n`` and the place ``at`` of the region's shingle in the set's
    order, so that any two sets that link share a region. A region with at most
    ``leaf`` open pairs compares those with room for a link; larger ones take 16, 256 and so on pivots.
    """
    far, hair = 1 - percent / 100, 1e-9  # fractions are rounded: a hair of slack lets more through, never less
    node = F.struct("doc", "rid")
    labels, pivots = _first_links(sets_of, members, percent), 16
    while True:
        placed = stored(_open_regions(members, labels), "regions")
        if placed.isEmpty():
            return labels
        roomy = _with_partner(placed, percent).select("region", "doc", "rid", "n", "at")
        placed = stored(_open_regions(roomy, labels), "regions")
        open_pairs = (F.col("minors") * F.col("size")).alias("open")
        rows = placed.select("region", node.alias("x"), "n", "at", "label", "minor", open_pairs)
        small, large = rows.filter(F.col("open") <= leaf), rows.filter(F.col("open") > leaf)
        others = small.filter("minor").selectExpr("region", "x y", "n m", "at place", "label other")
        once = ~F.col("minor") | (F.col("x") < F.col("y"))
        either_way = _may_link(percent, *map(F.col, ("n", "at", "m", "place")))
        leaves = small.join(others, "region").filter((F.col("label") != F.col("other")) & once & either_way)
        kind = F.pmod(F.xxhash64("x", F.lit(pivots)), F.lit(pivots))
        chosen = large.filter("minor").groupBy("region", kind.alias("kind")).agg(F.min("x").alias("y"))
        chosen = chosen.select("region", "y")
        measured = large.join(chosen, "region").filter(F.col("x") != F.col("y"))
        wanted = leaves.select("x", "y").unionByName(measured.select("x", "y"))
        wanted = wanted.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        known = _distances(wanted, sets_of)
        labels = connected_components(_links(known, percent).unionByName(labels.toDF("a", "b")))

        distance = known.select("x", "y", (1 - F.col("shared") / F.col("both")).alias("d"))
        either = distance.unionByName(distance.select(F.col("y").alias("x"), F.col("x").alias("y"), "d"))
        retired = chosen.select("region", F.col("y").alias("x"))
        left = measured.join(retired, ["region", "x"], "left_anti").join(either, ["x", "y"])
        homes = left.filter("minor").groupBy("region", "x").agg(F.min(F.struct("d", "y")).alias("home"))
        highest = homes.groupBy("region", F.col("home.y").alias("y")).agg(F.max("home.d").alias("high"))
        # who is linked with the pivot is in one component: a pair still open has a member beyond
        outer = left.filter(F.col("d") > far - hair).groupBy("region", "y").agg(F.min("d").alias("outer"))
        within = (F.col("d") <= F.col("high") + far + hair) & (F.col("outer") <= F.col("d") + far + hair)
        members = left.join(highest.join(outer, ["region", "y"]), ["region", "y"]).filter(within)
        region = F.xxhash64("region", "y", F.lit(pivots)).alias("region")
        members = stored(members.select(region, "x.doc", "x.rid", "n", "at"), "members")
        settle(members.sparkSession)
        pivots *= 16


def near_duplicates(
    documents: DataFrame, width: int = 5, percent: int = 75, leaf: int = 1 << 18, largest_width: int = 1 << 28
) -> DataFrame:
    """Per row: doc_id, n_shingles and component_id, the smallest doc_id reachable by links.

    Needs ``doc_id`` and ``text``; further columns are ignored. A document's set are its
    distinct ``width``-word shingles, A-Z lower-cased; with fewer words the whole
    sequence; without words (or NULL text) it is empty and linked with nothing. Two
    documents link when ``100 * intersection >= percent * union``.

    Rows that share a doc_id are one document to the links, each with its own set. A NULL
    doc_id can't be linked to: such rows have a NULL component_id. An empty table gives
    an empty result.
    """
    texts = keyed(documents)
    size = texts.select(F.sum(F.octet_length("text"))).first()[0] or 0
    seen = seen_twice([(texts, _shingles(width))], sketch_width(size // 6, load=1, largest=largest_width), levels=True)
    sets = stored(texts.mapInArrow(_sets(width, percent, seen), _SETS), "sets")

    point = ["f1", "f2", "n"]
    named = sets.filter((F.col("n") > 0) & (F.col("doc") != LAST))
    classes = named.groupBy(*point).agg(F.min(F.struct("doc", "rid")).alias("first"), F.max("may").alias("may"))
    points = stored(classes.filter("may").select("first.doc", "first.rid", "n"), "points")
    n_points, shingles = points.select(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    # whole rows that repeat are one text
    repeated = not named.groupBy("doc", "rid").count().filter("count > 1").isEmpty()

    chosen = _bit_map(points, n_points)
    blocks = 1 << max(4, (shingles // 4 // _GATHERED).bit_length())
    placed = texts.filter(F.col("doc") != LAST).mapInArrow(_prefixes(width, percent, seen, chosen, blocks), _PLACED)
    placed = placed.repartition("block").sortWithinPartitions("block")
    members = placed.mapInArrow(_members(), _MEMBERS)
    members = stored(members.dropDuplicates(["region", "doc", "rid"]) if repeated else members, "members")
    seen.release()
    chosen.release()
    settle(documents.sparkSession)

    def sets_of(wanted: DataFrame, rows: int) -> tuple[DataFrame, Callable[[], None]]:
        names = _bit_map(wanted, rows)
        found = texts.mapInArrow(_shingles_of(width, names), _SHINGLES)
        return found.dropDuplicates(["doc", "rid"]) if repeated else found, names.release

    labels = near_duplicate_links(sets_of, members, percent, leaf)

    several = named.groupBy("doc").agg(F.min("f1").alias("low"), F.max("f1").alias("high"))
    several = named.join(several.filter(F.col("low") < F.col("high")), "doc", "left_semi")
    same_id = several.join(classes, point).select(F.col("doc").alias("a"), F.col("first.doc").alias("b"))
    if not same_id.isEmpty():
        labels = connected_components(labels.toDF("a", "b").unionByName(same_id))
    ids = sets.select("doc", "n", *point[:2]).join(classes, point, "left")
    at = F.coalesce(F.col("first.doc"), F.col("doc"))
    placed = ids.withColumn("at", at).join(labels, F.col("at") == F.col("node"), "left")
    return placed.select(
        id_of(F.col("doc")).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        id_of(F.coalesce("component", "at")).alias("component_id"),
    )


def one_of_each_group(documents: DataFrame, width: int = 5, percent: int = 75, broadcast_rows: int = 1 << 20) -> DataFrame:
    """The rows, with all their columns, without those whose component has a smaller doc_id.

    Of rows that share a doc_id the one with the least text stays; all rows with a NULL
    doc_id stay.
    """
    found = near_duplicates(documents, width, percent)
    extra = stored(found.filter(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct(), "copies")
    settle(documents.sparkSession)
    if extra.count() <= broadcast_rows:
        extra = F.broadcast(extra)
    kept = documents.join(extra, "doc_id", "left_anti").select(*documents.columns)
    if not repeats_ids(documents):
        return kept
    row = F.struct(*documents.columns)
    order = W.partitionBy("row.doc_id").orderBy(F.col("row.text").asc_nulls_last())
    ranked = kept.select(row.alias("row")).withColumn("rank", F.row_number().over(order))
    return ranked.filter((F.col("rank") == 1) | F.col("row.doc_id").isNull()).select("row.*")
