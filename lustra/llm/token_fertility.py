"""Quality by tokeniser fertility: how well public vocabularies fit a text.

Each word of a text is encoded by itself with a public vocabulary. Prose of a language
gives a usual number of characters per token, hardly any bytes outside the vocabulary and
a varied use of tokens; tables, symbol runs, shouting and loops leave these bands. Bands
are fixed for each vocabulary and language, else for the script.
"""

from __future__ import annotations

from dataclasses import astuple, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lustra.llm.memory import portions, returning
from lustra.llm.symbols import BYTE_VALUES, Chunk, Runs, chunks, mixed, run_starts

U64 = np.uint64
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

#: Fixed value: the split that was published with the rank files, before whose merges it is applied.
RANK_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

#: First code points of scripts told apart, ascending; letters below the first are Latin.
SCRIPTS = ((0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0590, "Semitic"), (0x0900, "Indic"), (0x2E80, "CJK"))


@dataclass(frozen=True)
class Band:
    """What a text may measure. Entropy is in bits per token over its largest possible value.

    Short texts vary more: the limits on characters per token widen by ``slack`` over
    the square root of the number of words.
    """

    least_chars: float
    most_chars: float
    most_fallback: float
    least_entropy: float
    slack: float = 0.8


#: Bands by vocabulary, then by language, else script, else ``*``; ``*`` also holds for other vocabularies.
#: Least characters per token are the median of good texts less 0.14 (pieces) and 0.06 (byte pairs).
BANDS = {
    "piece_bpe_32k": {
        "en": Band(2.08, 6.0, 0.02, 0.30),
        "de": Band(2.10, 6.0, 0.02, 0.30),
        "fr": Band(1.84, 6.0, 0.02, 0.30),
        "es": Band(1.80, 6.0, 0.02, 0.30),
    },
    "byte_bpe_multi_50k": {
        "en": Band(2.17, 6.0, 0.03, 0.25),
        "de": Band(2.25, 6.0, 0.05, 0.25),
        "fr": Band(1.98, 6.0, 0.05, 0.25),
        "es": Band(2.00, 6.0, 0.05, 0.25),
    },
    "*": {
        "Latin": Band(1.20, 9.0, 0.10, 0.25),
        "Cyrillic": Band(0.80, 8.0, 0.30, 0.25),
        "Greek": Band(0.50, 8.0, 0.60, 0.25),
        "Semitic": Band(0.50, 8.0, 0.60, 0.25),
        "Indic": Band(0.25, 8.0, 1.0, 0.20),
        "CJK": Band(0.25, 6.0, 1.0, 0.20),
        "*": Band(0.20, 12.0, 1.0, 0.15),
    },
}


def band_of(bands: dict, vocabulary: str, language: str | None, script: str) -> Band:
    """The closest band: by language, then by script, of this vocabulary before that of any."""
    own, rest = bands.get(vocabulary, {}), bands["*"]
    return own.get(language) or own.get(script) or rest.get(language) or rest.get(script) or rest["*"]


@dataclass(frozen=True)
class Vocabulary:
    """A public vocabulary file: a sentencepiece model, or a tiktoken rank file with its split pattern."""

    path: str
    pattern: str = RANK_PATTERN

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1].rsplit(".", 1)[0]

    def encoder(self):
        """Words, each as after a space, to lists of ids, and the ids that stand for single bytes outside the vocabulary."""
        if self.path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=self.path)
            single = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
            return lambda words: model.encode(words, num_threads=1), single
        import base64

        import tiktoken

        with open(self.path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        model = tiktoken.Encoding("words", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        # single bytes above 0x7F are halves of characters the vocabulary has no token for
        single = np.zeros(max(ranks.values()) + 1, bool)
        single[[i for b, i in ranks.items() if len(b) == 1 and b[0] > 0x7F]] = True
        return lambda words: [model.encode_ordinary(" " + w) for w in words], single


@dataclass
class _Encoded:
    """Words already encoded, by their 64-bit hash, whose equality is taken for theirs.

    Forgets everything when it holds ``most`` words.
    """

    encode: object
    most: int = 1 << 18
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, U64))
    starts: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    sizes: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.empty(0, np.int32))

    def __call__(self, keys: np.ndarray, words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and size in the returned ids, for distinct sorted keys; ``words(i)`` are the texts at places i."""
        if len(self.keys) > self.most:
            self.keys, self.starts, self.sizes = self.keys[:0], self.starts[:0], self.sizes[:0]
            self.ids = self.ids[:0]
        new = np.flatnonzero(~self._known(keys))
        if len(new):
            lists = self.encode(words(new))
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter((i for one in lists for i in one), np.int32, int(sizes.sum()))
            starts = len(self.ids) + np.cumsum(sizes) - sizes
            order = np.argsort(np.r_[self.keys, keys[new]], kind="stable")
            self.keys = np.r_[self.keys, keys[new]][order]
            self.starts = np.r_[self.starts, starts][order]
            self.sizes = np.r_[self.sizes, sizes][order]
            self.ids = np.r_[self.ids, flat]
        at = np.searchsorted(self.keys, keys)
        return self.starts[at], self.sizes[at], self.ids

    def _known(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[at] == keys


_encoders: dict[Vocabulary, tuple[_Encoded, np.ndarray]] = {}


def _encoder(vocabulary: Vocabulary) -> tuple[_Encoded, np.ndarray]:
    """One per worker process; ``good_texts`` drops it after each partition, as other steps follow in the same workers."""
    if vocabulary not in _encoders:
        encode, single = vocabulary.encoder()
        _encoders[vocabulary] = (_Encoded(encode), single)
    return _encoders[vocabulary]


def _forget() -> None:
    _encoders.clear()


def _sum_by(bounds: np.ndarray, values: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values, dtype=np.int64)]
    return total[bounds[1:]] - total[bounds[:-1]]


def base_counts(chunk: Chunk, words: tuple[np.ndarray, np.ndarray, np.ndarray], values: np.ndarray) -> dict:
    """Counts of each text by the base rules."""
    starts, ends, doc = words
    texts, data, bounds = len(chunk), chunk.data, chunk.bounds
    word_at = np.searchsorted(doc, np.arange(texts + 1))
    points = np.r_[0, np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)]
    n_words = np.diff(word_at)
    word_chars = _sum_by(word_at, points[ends] - points[starts])

    # lines: of the line feeds and text ends, whichever comes next
    feed = np.flatnonzero(data == 0x0A)
    begin = np.unique(np.r_[bounds[:-1], feed + 1])
    begin = begin[begin < len(data)]
    line_doc = np.searchsorted(bounds, begin, "right") - 1
    feeds_before = np.searchsorted(feed, begin)
    end = np.minimum(np.r_[feed, len(data)][feeds_before], bounds[line_doc + 1])
    first_word = np.searchsorted(starts, begin)
    has_word = np.r_[starts, len(data)][first_word] < end
    begin, end, line_doc = begin[has_word], end[has_word], line_doc[has_word]
    line = Runs(BYTE_VALUES[0][data]).of(begin, end - begin)
    order = np.lexsort((line, line_doc))
    again = ~run_starts(line_doc[order], line[order])
    n_dup_lines = np.bincount(line_doc[order][again], minlength=texts)

    n_repeat_words = np.zeros(texts, np.int64)
    if len(values) >= 5:
        window = Runs(values, 1).every(5)
        inside = np.flatnonzero(doc[: len(window)] == doc[4:])
        own = mixed(window[inside] ^ mixed(doc[inside].astype(U64)))
        order = np.argsort(own)
        opens = run_starts(own[order])
        group = np.cumsum(opens) - 1
        twice = inside[order][(np.bincount(group) > 1)[group]]
        steps = np.zeros(len(values) + 1, np.int64)
        np.add.at(steps, twice, 1)
        np.add.at(steps, twice + 5, -1)
        n_repeat_words = _sum_by(word_at, np.cumsum(steps[:-1]) > 0)
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": _sum_by(bounds, _SYMBOL[data]),
        "n_dup_lines": n_dup_lines,
        "n_repeat_words": n_repeat_words,
    }


def _entropy(doc: np.ndarray, ids: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Bits per token of each text over log2 of its tokens; 1 for a text of one token or none."""
    key = np.sort(doc.astype(np.int64) << 32 | ids)
    opens = np.flatnonzero(run_starts(key)) if len(key) else np.empty(0, np.int64)
    count = np.diff(np.r_[opens, len(key)]).astype(float)
    own = (key[opens] >> 32).astype(np.int64)
    share = count / tokens[own]
    bits = np.bincount(own, -share * np.log2(share), minlength=len(tokens))
    most = np.log2(np.maximum(tokens, 2))
    return np.where(tokens > 1, bits / most, 1.0)


def _scripts(chunk: Chunk) -> list[str]:
    """The script that most letters beyond ASCII and Latin are in, if they are a third of all characters."""
    data = np.r_[chunk.data, 0, 0].astype(np.int64)  # a text's last characters count whether or not its chunk goes on
    lead = data[:-2]
    # code points of three-byte sequences, two-byte sequences and single bytes
    point = np.where(
        lead >= 0xE0,
        (lead & 0x0F) << 12 | (data[1:-1] & 0x3F) << 6 | (data[2:] & 0x3F),
        np.where(lead >= 0xC0, (lead & 0x1F) << 6 | (data[1:-1] & 0x3F), 0),
    )
    doc = chunk.doc_of_bytes()
    far = point >= SCRIPTS[0][0]
    names = ["Latin"] * len(chunk)
    if far.any():
        chars = _sum_by(chunk.bounds, (chunk.data & 0xC0) != 0x80)
        which = np.searchsorted([p for p, _ in SCRIPTS], point[far], "right") - 1
        table = np.zeros((len(chunk), len(SCRIPTS)), np.int64)
        np.add.at(table, (doc[far], which), 1)
        for i in np.flatnonzero(3 * table.max(axis=1) >= np.maximum(chars, 1)):
            names[i] = SCRIPTS[int(table[i].argmax())][1]
    return names


def _measured(vocabularies: tuple[Vocabulary, ...], bands: dict[str, dict[str, Band]]):
    def of(batches):
        encoders = [_encoder(v) for v in vocabularies]
        for batch in batches:
            langs = batch.column("language").to_pylist()
            parts = []
            for chunk in chunks(batch.column("text"), 1 << 18):
                starts, ends, doc = words = chunk.words()
                values = chunk.word_values(starts, ends)
                out = base_counts(chunk, words, values)
                raw = chunk.data.tobytes()
                keys, first, back = np.unique(values, return_index=True, return_inverse=True)
                scripts = _scripts(chunk)
                own = [langs[chunk.first + i] for i in range(len(chunk))]
                slack = 1 / np.sqrt(np.maximum(out["n_words"], 1))
                fits = np.ones(len(chunk), bool)
                for vocabulary, (encoded, single) in zip(vocabularies, encoders):
                    text_of = lambda at: [raw[starts[i] : ends[i]].decode() for i in first[at]]  # noqa: E731, B023
                    begin, size, ids = encoded(keys, text_of)
                    begin, size = begin[back], size[back]
                    each = np.repeat(np.arange(len(back)), size)
                    flat = ids[np.arange(len(each)) + np.repeat(begin - (np.cumsum(size) - size), size)]
                    tokens = np.bincount(doc[each], minlength=len(chunk))
                    some = np.maximum(tokens, 1)
                    measured = {
                        "chars_per_token": out["word_chars"] / some,
                        "fallback_share": np.bincount(doc[each], single[flat], minlength=len(chunk)) / some,
                        "token_entropy": _entropy(doc[each], flat, tokens),
                    }
                    band = [band_of(bands, vocabulary.name, a, b) for a, b in zip(own, scripts)]
                    least, most, fallback, entropy, wider = np.array([astuple(b) for b in band]).T
                    fits &= measured["chars_per_token"] >= least - wider * slack
                    fits &= measured["chars_per_token"] <= most + wider * slack
                    fits &= measured["fallback_share"] <= fallback
                    fits &= measured["token_entropy"] >= entropy
                    out |= {f"{vocabulary.name}_{k}": v for k, v in measured.items()}
                out |= {"script": np.array(scripts, object), "fits": fits}
                parts.append(out)
            if not parts:
                continue
            names = list(parts[0])
            columns = [np.concatenate([p[n] for p in parts]) for n in names]
            rest = [c for c in batch.schema.names if c not in ("text", "language")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in rest] + [pa.array(c) for c in columns], names=rest + names
            )

    return of


def _good(vocabularies: tuple[Vocabulary, ...], bands: dict[str, dict[str, Band]], language: str | None):
    measure = _measured(vocabularies, bands)

    def of(batches):
        for batch in (part for whole in batches for part in portions(whole)):
            text = batch.column("text")
            langs = batch.column(language).cast(pa.string()) if language else pa.nulls(len(text), pa.string())
            only = pa.RecordBatch.from_arrays([text, langs], names=["text", "language"])
            for measured in measure(iter([only])):
                n, repeated, fits = (
                    measured.column(c).to_numpy(zero_copy_only=False) for c in ("n_words", "n_repeat_words", "fits")
                )
                yield batch.filter(pa.array(~base_failed(n, repeated) & fits))

    return of


def base_failed(n_words, n_repeat_words):
    """Under 10 words, or over 20 % of the words in repeated 5-word windows; of arrays or columns."""
    return (n_words < 10) | (100 * n_repeat_words > 20 * n_words)


def good_texts(
    documents: DataFrame,
    vocabularies: tuple[Vocabulary, ...],
    bands: dict[str, dict[str, Band]] = BANDS,
    language: str | None = "lang",
) -> DataFrame:
    """The rows, with all their columns, that ``token_quality`` keeps; whatever other columns are called.

    NULL, empty and very long texts are treated as there; repeated rows all stay or all go.
    """
    known = language if language and language in documents.columns else None
    return documents.mapInArrow(returning(_good(vocabularies, bands, known), _forget), documents.schema)


def token_quality(
    documents: DataFrame,
    vocabularies: tuple[Vocabulary, ...],
    bands: dict[str, dict[str, Band]] = BANDS,
    language: str | None = "lang",
) -> DataFrame:
    """Per row: doc_id, base counts, ``base_failed``, each vocabulary's measures, script and ``kept``.

    Needs ``doc_id`` and ``text``, and ``language`` if the table has it; further columns
    are ignored. ``kept`` is false if ``base_failed`` (under 10 words, or over 20 % of the
    words in repeated 5-word windows), or if a measure leaves the band of its vocabulary.
    A language without a band falls back to its script's, then to ``*``.

    NULL and empty texts have no words and fail the base rules. A very long text is measured
    whole, by one task. Equal rows get equal results. An empty table gives an empty result.
    """
    known = language and language in documents.columns
    lang = F.col(language).cast("string") if known else F.lit(None).cast("string")
    texts = documents.select("doc_id", "text", lang.alias("language"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    measures = [f"{v.name}_{m}" for v in vocabularies for m in ("chars_per_token", "fallback_share", "token_entropy")]
    schema = f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, " + ", ".join(
        [f"{c} long" for c in counts] + [f"`{m}` double" for m in measures] + ["script string", "fits boolean"]
    )
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    measured = texts.mapInArrow(_measured(vocabularies, bands), schema)
    return (
        measured.withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & F.col("fits"))
        .select("doc_id", *counts, "base_failed", "kept", "script", *measures)
    )
