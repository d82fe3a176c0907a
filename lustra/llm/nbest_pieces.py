"""The best segmentations of a text into pieces of a public SentencePiece model, and back.

A text's lattice has an edge for every piece that matches at a place; a character that
is no piece has one edge of its byte pieces. A forward Viterbi pass gives each place
the score of the best path up to it. An A-star search from the end backward then uses these
scores as its estimate: they are exact, so paths come out best first.

The lattice falls apart wherever no piece can reach across: before a run of spaces that
follows something else, and around line feeds. Such units are searched once each. The best
paths of the text combine those of its units: at most n - 1 units leave their best path, and
only the n - 1 units with the closest second path can be among them. What a unit loses by
its second path is the most that an edge off the best path reaches, from forward and
backward scores, so these are found for whole chunks with numpy; the search runs for
the few units that matter.
"""

from __future__ import annotations

import hashlib
import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lustra.llm.memory import returning
from lustra.llm.symbols import BYTE_VALUES, Chunk, Runs, chunks, mixed

U64 = np.uint64
SPACE = "▁"
_WIDEST = 32
#: Units a worker keeps the searched paths of, over a kilobyte each.
_SEARCHED = 1 << 13
_STEP = U64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Pieces:
    """A SentencePiece model file with byte pieces. Its pieces and scores are used as they are."""

    path: str


class Lattice:
    """Pieces by text, with the edges and paths of a unit."""

    def __init__(self, pieces: Pieces):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=pieces.path)
        size = model.get_piece_size()
        self.score, self.byte_id, self.bytes_of = {}, np.zeros(256, np.int32), [b""] * size
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.score[piece] = (model.get_score(i), i)
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.score):
            raise ValueError("a piece of this model reaches across the cuts between units")
        self.fallback = min(s for s, _ in self.score.values() if s > -1e8) - 10
        self.longest = max(map(len, self.score))
        self._tables = [None] + [self._table(k) for k in range(1, self.longest + 1)]
        lengths = np.array([len(b) for b in self.bytes_of])
        self.byte_sizes, self.byte_starts = lengths, np.cumsum(lengths) - lengths
        self.byte_data = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def edges(self, unit: str, at: int) -> list[tuple[int, float, tuple[int, ...]]]:
        """End, score and ids of every edge from a place."""
        found = []
        for end in range(at + 1, min(len(unit), at + self.longest) + 1):
            hit = self.score.get(unit[at:end])
            if hit:
                found.append((end, hit[0], (hit[1],)))
            elif end == at + 1:
                raw = unit[at].encode()
                found.append((end, self.fallback * len(raw), tuple(int(self.byte_id[b]) for b in raw)))
        return found

    def best_paths(self, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best scores and ids: forward Viterbi, then A-star from the end."""
        size = len(unit)
        forward = [0.0] + [-np.inf] * size
        into: list[list] = [[] for _ in range(size + 1)]
        for at in range(size):
            for end, score, ids in self.edges(unit, at):
                into[end].append((at, score, ids))
                forward[end] = max(forward[end], forward[at] + score)
        # of equal estimates the one nearest to the start goes first: ties can't pile up
        heap, order, done = [(-forward[size], size, 0, 0.0, None)], 0, []
        while heap and len(done) < n:
            _, at, _, behind, path = heapq.heappop(heap)
            if at == 0:
                ids = []
                while path:
                    ids += path[0]
                    path = path[1]
                done.append((behind, tuple(ids)))
                continue
            for start, score, own in into[at]:
                order += 1
                heapq.heappush(heap, (-(forward[start] + score + behind), start, order, score + behind, (own, path)))
        return done

    def _table(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashes of the pieces of k characters, ascending, with scores and ids."""
        own = [(p, *v) for p, v in self.score.items() if len(p) == k]
        codes = np.array([[ord(c) for c in p] for p, _, _ in own], U64).reshape(len(own), k)
        keys = np.zeros(len(own), U64)
        for i in range(k):
            keys = keys * _STEP + codes[:, i] + U64(1)
        keys = mixed(keys)
        order = np.argsort(keys)
        return keys[order], np.array([s for _, s, _ in own])[order], np.array([i for _, _, i in own], np.int64)[order]

    def viterbi(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Of each unit the best score, the loss of its second path, and the best path's ids."""
        score, loss = np.zeros(len(units)), np.full(len(units), np.inf)
        ids: list[np.ndarray] = [np.empty(0, np.int32)] * len(units)
        sizes = np.fromiter(map(len, units), np.int64, len(units))
        below = 0
        for width in (4, 6, 8, 10, 12, 16, 22, _WIDEST):
            some = np.flatnonzero((sizes > below) & (sizes <= width))
            below = width
            for part in np.array_split(some, max(1, len(some) // 4096)):
                if len(part):
                    score[part], loss[part], own = self._viterbi([units[i] for i in part], sizes[part], width)
                    for i, path in zip(part.tolist(), own):
                        ids[i] = path
        for i in np.flatnonzero(sizes > _WIDEST).tolist():
            two = self.best_paths(units[i], 2)
            score[i], ids[i] = two[0][0], np.array(two[0][1], np.int32)
            loss[i] = two[0][0] - two[1][0] if len(two) > 1 else np.inf
        return score, loss, ids

    def _viterbi(self, units: list[str], sizes: np.ndarray, width: int):
        rows = len(units)
        flat = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32)
        codes = np.zeros((rows, width), U64)
        inside = np.arange(width) < sizes[:, None]
        codes[inside] = flat
        longest = min(self.longest, width)
        scores, found = [None], [None]
        keys = np.zeros((rows, width), U64)
        for k in range(1, longest + 1):
            keys = keys[:, : width - k + 1] * _STEP + codes[:, k - 1 :] + U64(1)
            known, value, number = self._tables[k]
            key = mixed(keys)
            at = np.minimum(np.searchsorted(known, key), max(len(known) - 1, 0))
            hit = known[at] == key if len(known) else np.zeros(key.shape, bool)
            scores.append(np.where(hit, value[at], -np.inf) if len(known) else np.full(key.shape, -np.inf))
            found.append(np.where(hit, number[at], -1) if len(known) else np.full(key.shape, -1))
            if k == 1:
                raw = 1 + (codes >= 0x80).astype(int) + (codes >= 0x800) + (codes >= 0x10000)
                none = ~hit & inside
                scores[1] = np.where(none, raw * self.fallback, scores[1])
                found[1] = np.where(none, -2 - codes.astype(np.int64), found[1])
        forward, last = np.full((rows, width + 1), -np.inf), np.zeros((rows, width + 1), np.int64)
        forward[:, 0] = 0
        for j in range(1, width + 1):
            for k in range(1, min(j, longest) + 1):
                way = forward[:, j - k] + scores[k][:, j - k]
                better = way > forward[:, j]
                forward[:, j] = np.where(better, way, forward[:, j])
                last[:, j] = np.where(better, k, last[:, j])
        backward = np.full((rows, width + 1), -np.inf)
        each = np.arange(rows)
        backward[each, sizes] = 0
        for i in range(width - 1, -1, -1):
            for k in range(1, min(width - i, longest) + 1):
                backward[:, i] = np.maximum(backward[:, i], scores[k][:, i] + backward[:, i + k])
        best = forward[each, sizes]
        on_path = [None] + [np.zeros((rows, width - k + 1), bool) for k in range(1, longest + 1)]
        path, at, step = np.full((rows, width), -1, np.int64), sizes.copy(), width
        taken = np.zeros(rows, np.int64)
        while (at > 0).any():
            step -= 1
            k_of = np.where(at > 0, last[each, at], 0)
            for k in np.unique(k_of[k_of > 0]).tolist():
                r = np.flatnonzero(k_of == k)
                on_path[k][r, at[r] - k] = True
                path[r, width - 1 - taken[r]] = found[k][r, at[r] - k]
                taken[r] += 1
            at = at - k_of
        second = np.full(rows, -np.inf)
        for k in range(1, longest + 1):
            through = forward[:, : width - k + 1] + scores[k] + backward[:, k:]
            second = np.maximum(second, np.where(on_path[k], -np.inf, through).max(axis=1))
        paths = []
        plain = (path >= -1).all(axis=1)
        for r in range(rows):
            own = path[r, width - taken[r] :]
            if not plain[r]:
                wide = [self.byte_id[list(chr(-2 - i).encode())] if i < 0 else [i] for i in own.tolist()]
                own = np.concatenate(wide)
            paths.append(own.astype(np.int32))
        return best, best - second, paths

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of pieces, spaces for marks; a text's first byte is the mark put before it."""
        sizes = self.byte_sizes[ids]
        at = np.repeat(self.byte_starts[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
        return self.byte_data[at]


class _Known:
    """Units seen before, by hash; forgets them all when there are too many."""

    def __init__(self, lattice: Lattice, most: int = 1 << 18):
        self._lattice, self._most = lattice, most
        self._forget()

    def _forget(self):
        self.keys, self.scores, self.losses = np.empty(0, U64), np.empty(0), np.empty(0)
        self.starts, self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)

    def places(self, keys: np.ndarray, text_of) -> np.ndarray:
        """Where in this table the distinct keys are, after adding the new ones."""
        if len(self.keys) > self._most:
            self._forget()
        at = np.searchsorted(self.keys, keys)
        have = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        have[inside] = self.keys[at[inside]] == keys[inside]
        new = np.flatnonzero(~have)
        if len(new):
            scores, losses, ids = self._lattice.viterbi([text_of(i) for i in new])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            order = np.argsort(np.r_[self.keys, keys[new]], kind="stable")
            starts = len(self.ids) + np.cumsum(sizes) - sizes
            for name, value in (("keys", keys[new]), ("scores", scores), ("losses", losses), ("starts", starts), ("sizes", sizes)):
                setattr(self, name, np.r_[getattr(self, name), value][order])
            self.ids = np.concatenate([self.ids, *ids])
            at = np.searchsorted(self.keys, keys)
        return at


_known: dict[str, tuple[Lattice, _Known, dict[int, dict]]] = {}


def _worker(pieces: Pieces) -> tuple[Lattice, _Known, dict[int, dict]]:
    """One lattice and table of units per worker process, and the searched units of each N.

    Units are known by 64-bit hashes, and equal hashes count as equal units.
    """
    if pieces.path not in _known:
        lattice = Lattice(pieces)
        _known[pieces.path] = (lattice, _Known(lattice), {})
    return _known[pieces.path]


def _units(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end, text and opening flag of every unit; the units of a text cover it."""
    data, n = chunk.data, len(chunk.data)
    space, feed = data == 0x20, data == 0x0A
    opens = np.zeros(n, bool)
    opens[1:] = (space[1:] & ~space[:-1]) | feed[1:] | feed[:-1]
    first = chunk.bounds[:-1][np.diff(chunk.bounds) > 0]
    opens[first] = True
    starts = np.flatnonzero(opens)
    ends = np.r_[starts[1:], n] if n else starts
    doc = np.searchsorted(chunk.bounds, starts, "right") - 1
    return starts, ends, doc, np.isin(starts, first, assume_unique=True)


def _combined(units: list[tuple[int, list]], n: int) -> list[tuple[float, list[tuple[int, int]]]]:
    """The n least losses from choosing a path in each of some units, as (unit, path) other than the best."""
    best = [(0.0, [])]
    for place, paths in units:
        losses = [paths[0][0] - s for s, _ in paths]
        more = [(a + d, c + [(place, j)] if j else c) for a, c in best for j, d in enumerate(losses)]
        best = sorted(more, key=lambda x: x[0])[:n]
    return best


def _digest(ids: np.ndarray) -> str:
    return hashlib.sha256(ids.astype("<i4").tobytes()).hexdigest()


def _spliced(flat: np.ndarray, a: int, b: int, changed: list[tuple[int, int, tuple[int, ...]]]) -> np.ndarray:
    """The ids from a to b, with other ids in place of some stretches."""
    parts = []
    for start, end, ids in sorted(changed):
        parts += [flat[a:start], np.array(ids, np.int32)]
        a = end
    return np.concatenate([*parts, flat[a:b]])


def _encoded(pieces: Pieces, n: int, with_ids: bool, with_paths: bool, with_edits: bool = False):
    def of(batches):
        lattice, known, by_n = _worker(pieces)
        searched = by_n.setdefault(n, {})
        for batch in batches:
            for chunk in chunks(batch.column("text"), 1 << 18):
                starts, ends, doc, opening = _units(chunk)
                texts = len(chunk)
                values = Runs(BYTE_VALUES[0][chunk.data]).of(starts, ends - starts)
                values = np.where(opening, mixed(values + _STEP), values)
                raw = chunk.data.tobytes()
                keys, one, back = np.unique(values, return_index=True, return_inverse=True)

                def text_of(i, one=one, raw=raw, starts=starts, ends=ends, opening=opening):
                    u = one[i]
                    return SPACE * int(opening[u]) + raw[starts[u] : ends[u]].decode().replace(" ", SPACE)

                place = known.places(keys, text_of)[back]
                size = known.sizes[place]
                flat = known.ids[
                    np.repeat(known.starts[place] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
                ]
                total = np.bincount(doc, known.scores[place], minlength=texts)
                count = np.bincount(doc, size, minlength=texts).astype(np.int64)
                bounds = np.r_[0, np.cumsum(count)]
                losses = known.losses[place]
                order = np.lexsort((np.arange(len(doc)), losses, doc))
                opens = np.searchsorted(doc, np.arange(texts + 1))
                unit_ids = np.r_[0, np.cumsum(size)]
                scores, paths, edits = [], [], []
                for d in range(texts):
                    a, b = opens[d], opens[d + 1]
                    near = [u for u in order[a : min(b, a + n - 1)].tolist() if losses[u] < np.inf]
                    choices = []
                    for u in near:
                        key = int(values[u])
                        if key not in searched:
                            if len(searched) > _SEARCHED:
                                searched.clear()
                            # of paths that tie, the one in flat is the first here too
                            best = tuple(flat[unit_ids[u] : unit_ids[u + 1]].tolist())
                            found = lattice.best_paths(text_of(back[u]), n)
                            others = [path for path in found if path[1] != best]
                            searched[key] = [(found[0][0], best), *others][:n]
                        choices.append((u, searched[key]))
                    ranked = _combined(choices, n)
                    scores.append([total[d] - loss for loss, _ in ranked])
                    own = [flat[bounds[d] : bounds[d + 1]]]
                    apart = []
                    if with_paths:
                        at = dict(choices)
                        for rank, (_, changed) in enumerate(ranked[1:], 1):
                            other = sorted((unit_ids[u], unit_ids[u + 1], at[u][j][1]) for u, j in changed)
                            own.append(_spliced(flat, bounds[d], bounds[d + 1], other))
                            apart += [(rank, a - bounds[d], b - a, ids) for a, b, ids in other]
                    paths.append(own)
                    edits.append(apart)
                digests = [[_digest(ids) for ids in own] for own in paths]
                same = _paths_that_decode(lattice, paths, flat, bounds, chunk)
                few = None if with_paths else [None] * texts
                columns = [
                    batch.column("doc_id").slice(chunk.first, texts),
                    pa.array(count, pa.int64()),
                    _lists([own[0] for own in paths]) if with_ids or with_edits else pa.nulls(texts, pa.list_(pa.int32())),
                    pa.array(scores, pa.list_(pa.float64())),
                    _lists_of_lists(paths) if with_paths and with_ids else pa.nulls(texts, pa.list_(pa.list_(pa.int32()))),
                    _edits(edits) if with_edits else pa.nulls(texts, _EDITS),
                    pa.array([own[0] for own in digests], pa.string()),
                    pa.array([own[0] for own in same], pa.bool_()),
                    pa.array(few or [[len(ids) for ids in own] for own in paths], pa.list_(pa.int64())),
                    pa.array(few or digests, pa.list_(pa.string())),
                    pa.array(few or same, pa.list_(pa.bool_())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=_COLUMNS)

    return of


_COLUMNS = (
    "doc_id n_pieces ids scores paths edits ids_sha256 round_trip path_pieces path_sha256 path_round_trips"
).split()


_EDIT = pa.struct([("rank", pa.int32()), ("at", pa.int32()), ("size", pa.int32()), ("ids", pa.list_(pa.int32()))])
_EDITS = pa.list_(_EDIT)


def _edits(rows: list[list[tuple]]) -> pa.Array:
    bounds = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = [edit for row in rows for edit in row]
    numbers = np.array([edit[:3] for edit in flat], np.int32).reshape(-1, 3)
    ids = pa.array([edit[3] for edit in flat], pa.list_(pa.int32()))
    parts = [*(pa.array(numbers[:, i]) for i in range(3)), ids]
    return pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays(parts, fields=list(_EDIT)))


def path_of(ids: list[int], edits: list, rank: int) -> list[int]:
    """The path of a rank: the best path's ids with the edits of that rank put in."""
    path, at = [], 0
    for edit in edits:
        if edit["rank"] == rank:
            path += [*ids[at : edit["at"]], *edit["ids"]]
            at = edit["at"] + edit["size"]
    return path + ids[at:]


def _lists(rows: list[np.ndarray]) -> pa.Array:
    bounds = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(rows).astype(np.int32)))


def _lists_of_lists(rows: list[list[np.ndarray]]) -> pa.Array:
    bounds = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(bounds, _lists([ids for own in rows for ids in own]))


def _paths_that_decode(
    lattice: Lattice, paths: list[list[np.ndarray]], flat: np.ndarray, bounds: np.ndarray, chunk: Chunk
) -> list[list[bool]]:
    """For each path of each text whether its pieces decode to the very text; a rank at a time."""
    same = [[bool(x)] for x in _round_trips(lattice, flat, bounds, chunk)]
    for rank in range(1, max(map(len, paths))):
        # a text without a path of this rank takes part with its best one, unread
        ids = [own[rank] if rank < len(own) else own[0] for own in paths]
        found = _round_trips(lattice, np.concatenate(ids), np.cumsum([0, *map(len, ids)]), chunk)
        for own, mine, right in zip(paths, same, found.tolist()):
            if rank < len(own):
                mine.append(right)
    return same


def _round_trips(lattice: Lattice, flat: np.ndarray, bounds: np.ndarray, chunk: Chunk) -> np.ndarray:
    """True for each text whose pieces decode to the very text."""
    data = lattice.decoded(flat)
    ends = np.r_[0, np.cumsum(lattice.byte_sizes[flat])][bounds]
    some = np.diff(chunk.bounds) > 0
    sizes = np.diff(ends) - some
    fits = sizes == np.diff(chunk.bounds)
    keep = np.ones(len(data), bool)
    keep[ends[:-1][some]] = False
    if fits.all():
        wrong = np.r_[0, np.cumsum(data[keep] != chunk.data)]
        return wrong[chunk.bounds[1:]] == wrong[chunk.bounds[:-1]]
    return np.array(
        [
            data[a + s : b].tobytes() == chunk.data[c:d].tobytes()
            for a, b, s, c, d in zip(ends[:-1], ends[1:], some, chunk.bounds[:-1], chunk.bounds[1:])
        ]
    )


def encode(
    documents: DataFrame,
    pieces: Pieces,
    n: int = 4,
    with_ids: bool = True,
    with_paths: bool = False,
    with_edits: bool = False,
) -> DataFrame:
    """Per row: doc_id, n_pieces and ids of the best path, scores of the n best, ids_sha256, round_trip.

    Needs ``doc_id`` and ``text``; further columns are ignored. ``scores`` are sums of
    piece scores, best first, fewer if the text has fewer paths. ids_sha256 is over
    the ids as 32-bit little-endian numbers. round_trip says that the ids decode to the text.
    With ``with_paths`` each of the n best paths is built and decoded: ``paths`` are their ids,
    ``path_pieces``, ``path_sha256`` and ``path_round_trips`` say of each, in the order of ``scores``,
    what n_pieces, ids_sha256 and round_trip say of the best; else these four are NULL. Without
    ``with_ids``, ids and paths are NULL. Paths of equal score come in a fixed order.

    With ``with_edits`` (and ``with_paths``) ids are given, and in ``edits`` what the other paths have in
    place of stretches of the best one (rank, place, size, their ids; NULL else): all paths in
    little more room than one, as :func:`path_of` puts them together.

    NULL and empty texts have one empty path of score 0. Equal texts get equal results.
    An empty table gives an empty result.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        returning(_encoded(pieces, n, with_ids, with_paths, with_edits)),
        f"doc_id {kind}, n_pieces long, ids array<int>, scores array<double>, paths array<array<int>>, "
        "edits array<struct<rank int, at int, size int, ids array<int>>>, "
        "ids_sha256 string, round_trip boolean, path_pieces array<long>, path_sha256 array<string>, "
        "path_round_trips array<boolean>",
    )


def _decoded(pieces: Pieces):
    def of(batches):
        lattice, _, _ = _worker(pieces)
        for batch in batches:
            lists = batch.column("ids")
            bounds = lists.offsets.to_numpy()
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            data = lattice.decoded(flat)
            ends = np.r_[0, np.cumsum(lattice.byte_sizes[flat])][bounds - bounds[0]].tolist()
            texts = [data[a + 1 : b].tobytes().decode(errors="replace") for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return of


def decode(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``ids``; NULL and empty ids give an empty text."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(_decoded(pieces), f"doc_id {kind}, text string")
