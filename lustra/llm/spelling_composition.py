"""Spelling variants: pairs of words of a vocabulary that are one edit apart, and the form each stands for.

The pairs are what the composition V o E o V accepts, where V is the minimised acceptor
of the vocabulary and E the transducer of exactly one edit (copy, one insertion,
deletion or replacement, copy). Since V is deterministic, before the edit both sides
are in one state of V and after it they read the same symbols; so a composed state is
(state, no edit) or (left state, right state). The edit is put where the words first
differ, which makes each pair accepted once.

V is never built as a whole. It is partitioned by initial states: the state behind a
prefix, with all words that go on from there. A state with few words is one partition,
whose acceptor is built, minimised and composed in a task. A state with more words is
divided by its next symbol. Pairs that stay on one branch are found further down. Pairs
that leave it on different branches make their edit here, and read the same rest
afterwards: every word offers its rest with and without the symbol at this place, and
equal offers meet in a shuffle. At most one word for each letter, and one more, can meet in
one offer, so no group grows with the vocabulary.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lustra.llm.stored import stored

_SMALL = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_RUN = re.compile("[a-zÀ-ÿ]+")
_LONG = 1 << 22
_HELD = 1 << 18


# --- vocabulary ----------------------------------------------------------------


def _runs(text: bytes) -> Counter:
    letters = text.translate(_SMALL).decode()
    if len(letters) < _LONG:
        return Counter(_RUN.findall(letters))
    return Counter(m[0] for m in _RUN.finditer(letters))


def _counted(shortest: int, slip_every: int | None):
    def of(batches):
        counts: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                if not text.is_valid:
                    continue
                slips = slip_every if doc_id is not None else None
                start = crc32(f"{doc_id}:".encode())
                for run, n in _runs(text.as_buffer().to_pybytes()).items():
                    if slips and not (h := crc32(run.encode(), start)) % slips:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                    if len(run) >= shortest:
                        counts[run] = counts.get(run, 0) + n
            if len(counts) >= _HELD:
                yield _columns(["word", "n"], counts.keys(), counts.values())
                counts = {}
        yield _columns(["word", "n"], counts.keys(), counts.values())

    return of


def _columns(names: list[str], *values) -> pa.RecordBatch:
    arrays = [pa.array(list(v), pa.int64() if name in ("n", "near_n") else pa.string()) for name, v in zip(names, values)]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def vocabulary(
    documents: DataFrame, shortest: int = 6, least: int = 5, slip_every: int | None = None
) -> DataFrame:
    """``word`` and ``n``: words of at least ``shortest`` letters with ``least`` occurrences in all texts.

    Words are runs of letters (ASCII and U+00C0 to U+00FF), with A-Z made small. With
    ``slip_every`` a letter is deleted from about one run in so many, settled by
    doc_id and run: typing slips for tests of what is done about them. Rows with a NULL
    doc_id get none. NULL and empty texts have no words; rows that repeat count again.
    """
    found = documents.select("doc_id", "text").mapInArrow(_counted(shortest, slip_every), "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# --- acceptor and composition ----------------------------------------------------


class Acceptor:
    """The minimal acyclic acceptor of sorted distinct words. ``arcs[state]`` leads by letter; 0 is the start."""

    def __init__(self, words: list[str]):
        self.arcs: list[dict[str, int]] = [{}]
        self.final: list[bool] = [False]
        self._known: dict[tuple, int] = {}
        path: list[int] = [0]
        last = ""
        for word in words:
            same = 0
            while same < min(len(last), len(word)) and last[same] == word[same]:
                same += 1
            self._settle(last, path, same)
            for letter in word[same:]:
                self.arcs.append({})
                self.final.append(False)
                self.arcs[path[-1]][letter] = len(self.arcs) - 1
                path.append(len(self.arcs) - 1)
            self.final[path[-1]] = True
            last = word
        self._settle(last, path, 0)

    def _settle(self, last: str, path: list[int], keep: int) -> None:
        """States behind the first ``keep`` letters won't change: each becomes the one it equals, if there is one."""
        while len(path) > keep + 1:
            state = path.pop()
            key = (self.final[state], *self.arcs[state].items())
            self.arcs[path[-1]][last[len(path) - 1]] = self._known.setdefault(key, state)


class Composition:
    """Accepted pairs of V o E o V, enumerated from the start state."""

    def __init__(self, acceptor: Acceptor):
        self.v = acceptor
        self._both: dict[tuple[int, int], list[str]] = {}
        self._edits: dict[int, list[tuple[str, str]]] = {}

    def pairs(self) -> Iterator[tuple[str, str]]:
        """Composed states without an edit are states of V, reached by the words' common beginning."""
        open_states = [(0, "")]
        while open_states:
            state, begun = open_states.pop()
            for left, right in self._edits_at(state):
                yield begun + left, begun + right
            for letter, to in self.v.arcs[state].items():
                open_states.append((to, begun + letter))

    def _edits_at(self, state: int) -> list[tuple[str, str]]:
        """Rests of both words from a state on which their first letters differ. Kept: many beginnings share it."""
        if state not in self._edits:
            self._edits[state] = found = []
            arcs, final = self.v.arcs, self.v.final
            out = sorted(arcs[state].items())
            for i, (c, to) in enumerate(out):
                for d, other in out[i + 1 :]:  # c replaced by d
                    found += ((c + rest, d + rest) for rest in self._common(to, other))
                if final[state] and final[to]:  # c deleted at the end
                    found.append((c, ""))
                for d, other in out:  # c deleted before d
                    if d != c and d in arcs[to]:
                        found += ((c + d + rest, d + rest) for rest in self._common(arcs[to][d], other))
        return self._edits[state]

    def _common(self, a: int, b: int) -> list[str]:
        """Rests that both states accept: the composed states after the edit."""
        key = (a, b) if a < b else (b, a)
        if key not in self._both:
            self._both[key] = found = []
            todo = [(a, b, "")]
            while todo:
                a, b, rest = todo.pop()
                if self.v.final[a] and self.v.final[b]:
                    found.append(rest)
                for letter, to in self.v.arcs[a].items():
                    other = self.v.arcs[b].get(letter)
                    if other is not None:
                        todo.append((to, other, rest + letter))
        return self._both[key]


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by partition and word; one partition is held at a time."""
    at, words = None, {}
    for batch in batches:
        rows: list[tuple] = []
        for state, word, n in zip(*(batch.column(c).to_pylist() for c in ("state", "word", "n"))):
            if state != at:
                rows += _both_ways(words)
                at, words = state, {}
            words[word] = n
        if rows:
            yield _columns(["word", "near", "near_n"], *zip(*rows))
    rows = _both_ways(words)
    if rows:
        yield _columns(["word", "near", "near_n"], *zip(*rows))


def _both_ways(words: dict[str, int]) -> list[tuple]:
    if len(words) < 2:
        return []
    found = []
    for a, b in Composition(Acceptor(list(words))).pairs():
        found += ((a, b, words[b]), (b, a, words[a]))
    return found


# --- partitions ------------------------------------------------------------------


def _offers(words: DataFrame, depth: int) -> DataFrame:
    """Each word's rest behind a state, with and without its first letter. Equal ones belong to near words."""
    here = F.substring("word", depth + 1, 1).alias("at")
    without = F.concat(F.substring("word", 1, depth), F.expr(f"substring(word, {depth + 2})"))
    longer = F.char_length("word") > depth
    offers = F.array_compact(
        F.array(
            F.struct(F.col("word").alias("offer"), F.lit(True).alias("whole")),
            F.when(longer, F.struct(without.alias("offer"), F.lit(False).alias("whole"))),
        )
    )
    return words.select("word", "n", here, F.lit(depth).alias("place"), F.inline(offers))


def _met(offers: DataFrame) -> DataFrame:
    """Pairs whose edit is at the place of an offer. No more words meet in one than there are letters, and one."""
    one = F.struct("at", "word", "n")
    met = offers.groupBy("place", "offer").agg(F.collect_list(one).alias("met"))
    met = met.filter(F.size("met") > 1).select("met", F.explode("met").alias("a"))
    met = met.select("a", F.explode("met").alias("b"))
    differ = (F.col("a.word") != F.col("b.word")) & (F.col("a.at") != F.col("b.at"))
    return met.filter(differ).select(
        F.col("a.word").alias("word"), F.col("b.word").alias("near"), F.col("b.n").alias("near_n")
    )


def near_words(words: DataFrame, most: int = 256) -> DataFrame:
    """``word``, ``near``, ``near_n``: every pair one edit apart, both ways, with the other's count.

    ``words`` is a stored table of distinct ``word`` with ``n``. A state with more than
    ``most`` words is divided; ``most`` grows with the vocabulary beyond 2^17 states, so
    the states to be divided at one depth, which are broadcast, are at most that many.
    Depths are looked at one by one for as long as a state needs division, and the words
    behind these are stored: a few rounds for natural words, as many as letters for very
    many words with one long beginning. All offers meet in one shuffle, all small
    states are dealt out in another.
    """
    total = words.count()
    most = max(most, total >> 17)
    offers, settled, rest, depth = [], [], words, 0
    while total > most:
        offers.append(_offers(rest, depth))
        depth += 1
        # A word that ends before this depth has met its partners in the offers.
        state = F.substring("word", 1, depth).alias("state")
        rest = rest.filter(F.char_length("word") >= depth).select(state, "word", "n")
        large = stored(rest.groupBy("state").count().filter(F.col("count") > most), "states").select("state")
        settled.append(rest.join(F.broadcast(large), "state", "left_anti"))
        if large.isEmpty():
            break
        rest = stored(rest.join(F.broadcast(large), "state", "left_semi").select("word", "n"), "behind")
    else:
        settled.append(rest.select(F.lit("").alias("state"), "word", "n"))
    parts = reduce(DataFrame.unionByName, settled).repartition("state").sortWithinPartitions("state", "word")
    pairs = parts.mapInArrow(_composed, "word string, near string, near_n long")
    return pairs.unionByName(_met(reduce(DataFrame.unionByName, offers))) if offers else pairs


# --- forms -----------------------------------------------------------------------


def _roots(words: DataFrame) -> DataFrame:
    """Follow forms to the last. A form is commoner by a factor each time, so chains are short; they halve a round."""
    links = stored(words.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "forms")
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if links.join(further, "root", "left_semi").isEmpty():
            return links
        joined = links.join(further, "root", "left")
        links = stored(joined.select("word", F.coalesce("next", "root").alias("root")), "forms")


def spelling_groups(words: DataFrame, times: int = 5, most: int = 256) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` for every word of a vocabulary.

    Needs distinct words in ``word`` and their counts ``n``; further columns are
    ignored, rows with a NULL word are left out. Words are near if exactly one code point is inserted,
    deleted or replaced. ``form`` is the near word of largest n (ties: the smallest
    in code-point order) if that n is at least ``times`` (2 or more) the word's own, else NULL;
    ``root`` follows forms to the last and is the word itself if it has none. No words
    give no rows. Words of any length are compared as wholes.
    """
    if times < 2:
        raise ValueError("a form must be commoner: times is 2 or more")
    words = stored(words.filter(F.col("word").isNotNull()).select("word", "n"), "vocabulary")
    best = near_words(words, most).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best")
    )
    known = words.join(best, "word", "left")
    fits = -F.col("best.n") >= times * F.col("n")
    known = known.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"),
        F.when(fits, -F.col("best.n")).alias("form_n"),
    )
    known = stored(known, "near")
    return known.join(_roots(known), "word", "left").withColumn("root", F.coalesce("root", "word"))


def oracle_sql() -> str:
    """All of it for ``documents`` with a slip in 199 runs: pairs by deleted letters, roots by recursion."""
    return r"""
WITH RECURSIVE crc_steps AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
 lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS steps),
runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
 '[a-zÀ-ÿ]+')) AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
seeded AS (SELECT *, list_transform(string_split(doc_id::VARCHAR || ':' || run, ''), lambda x: unicode(x)) AS codes FROM counted),
hashed AS (SELECT doc_id, run, n, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(codes,
  lambda u: CASE WHEN u < 128 THEN [u] ELSE [192 + u // 64, 128 + u % 64] END))),
  lambda c, x: xor(c // 256, steps[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM seeded, crc_steps),
slipped AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
 FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS near FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
 UNION SELECT less.word, words.word FROM less JOIN words ON less.rest = words.word
 UNION SELECT words.word, less.word FROM less JOIN words ON less.rest = words.word),
best AS (SELECT pairs.word, count(*) AS n_near, arg_min(near, (-w.n, near)) AS near, max(w.n) AS near_n
 FROM pairs JOIN words w ON w.word = near GROUP BY pairs.word),
forms AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
 CASE WHEN near_n >= 5 * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
chains AS (SELECT word, word AS root FROM forms UNION ALL
 SELECT chains.word, forms.form FROM chains JOIN forms ON forms.word = chains.root WHERE forms.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n FROM forms
JOIN (SELECT chains.word, root FROM chains JOIN forms ON forms.word = root WHERE forms.form IS NULL) AS r USING (word)"""
