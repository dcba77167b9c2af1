"""Language identification by a small convolutional network over bytes.

Filters of two, three and four bytes slide over windows of a fixed length; the
largest response of each filter in the window goes through one softmax layer.
The network is trained in numpy on the driver, from a bounded sample of labelled
windows; texts are then scored where they lie, every window of them.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtrail.llm.texts import giving_back, ragged, slices

UNDETERMINED = "und"
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8  # of each width
PAD = 0x20
BLOCK = 512  # windows scored at once
# The sample: about so many documents of each language, so many windows of each.
TRAIN_DOCS = 600
TRAIN_WINDOWS = 4
# Labels that are learnt, the commonest ones; the sample grows with them.
MOST_LANGUAGES = 256
STEPS, BATCH, RATE, SHORTENED = 600, 128, 0.01, 0.35
HASH_STEPS = 1 << 20


def remainder(doc_id: str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; 0 for a missing id."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % mod, F.lit(0))


@dataclass
class Model:
    """``filters[i][k]`` (FILTERS, 256): what byte k under a filter of width
    WIDTHS[i] adds to its response."""

    languages: list[str]
    filters: list[list[np.ndarray]]
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def parameters(self):
        return [w for ws in self.filters for w in ws] + [self.bias, self.dense, self.offset]

    def pair_tables(self):
        """Responses to two neighbouring bytes at once, by first * 256 + second."""

        def pair(a, b):
            return (a[:, :, None] + b[:, None, :]).reshape(len(a), -1)

        two, three, four = self.filters
        return [
            (pair(*two), None),
            (pair(three[0], three[1]), three[2]),
            (pair(four[0], four[1]), pair(four[2], four[3])),
        ]

    def pooled(self, windows: np.ndarray, tables, places: bool = False):
        """The largest response of every filter, and where it is if asked."""
        x = windows.astype(np.int32)
        pairs = (x[:, :-1] << 8) | x[:, 1:]
        best = np.empty((len(x), len(WIDTHS) * FILTERS), np.float32)
        where = np.empty(best.shape, np.int64) if places else None
        for i, (head, tail) in enumerate(tables):
            span = WINDOW - WIDTHS[i] + 1
            first = pairs[:, :span]
            second = {2: None, 3: x[:, 2:], 4: pairs[:, 2:]}[WIDTHS[i]]
            for f in range(FILTERS):
                response = head[f].take(first)
                if tail is not None:
                    response += tail[f].take(second)
                column = i * FILTERS + f
                if places:
                    where[:, column] = response.argmax(axis=1)
                best[:, column] = response.max(axis=1)
        return np.maximum(best + self.bias, 0), where

    def probabilities(self, windows: np.ndarray, tables) -> np.ndarray:
        out = []
        for at in range(0, len(windows), BLOCK):
            hidden, _ = self.pooled(windows[at : at + BLOCK], tables)
            out.append(_softmax(hidden @ self.dense + self.offset))
        return np.concatenate(out)


def _softmax(x):
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def windows_of(part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of a slice's texts, in lower case as far as U+00FF and padded
    at a text's end; the row and the number of own bytes of each. An empty text
    has none."""
    low = part.lowered().data
    second = np.flatnonzero(low[:-1] == 0xC3) + 1
    capital = (low[second] < 0x9F) & (low[second] != 0x97)
    low[second[capital]] += 0x20
    sizes = part.ends - part.starts
    counts = -(-sizes // WINDOW)
    rows = np.repeat(np.arange(len(sizes)), counts)
    starts = np.repeat(part.starts, counts) + WINDOW * ragged(np.zeros_like(counts), counts)
    lengths = np.minimum(WINDOW, part.ends[rows] - starts)
    out = np.full((len(rows), WINDOW), PAD, np.uint8)
    own = np.arange(WINDOW) < lengths[:, None]
    out[own] = low
    return out, rows, lengths


def fit(windows: np.ndarray, labels: np.ndarray, languages: list[str], seed=7) -> Model:
    """Train by Adam on (n, WINDOW) bytes and their language's index."""
    rng = np.random.default_rng(seed)
    hidden = len(WIDTHS) * FILTERS
    model = Model(
        languages,
        [
            [rng.normal(0, 0.5, (FILTERS, 256)).astype(np.float32) for _ in range(w)]
            for w in WIDTHS
        ],
        np.zeros(hidden, np.float32),
        rng.normal(0, hidden**-0.5, (hidden, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    parameters = model.parameters()
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in parameters]
    rounds = -(-STEPS * BATCH // len(windows))
    order = np.concatenate([rng.permutation(len(windows)) for _ in range(rounds)])
    for step in range(1, STEPS + 1):
        pick = order[(step - 1) * BATCH : step * BATCH]
        batch = windows[pick].copy()
        short = np.flatnonzero(rng.random(len(pick)) < SHORTENED)
        ends = rng.integers(6, 80, len(short))
        batch[short] = np.where(np.arange(WINDOW) < ends[:, None], batch[short], PAD)
        for p, (m, v), g in zip(parameters, moments, _gradients(model, batch, labels[pick])):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def _gradients(model: Model, batch: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross entropy, in the order of ``Model.parameters``."""
    hidden, where = model.pooled(batch, model.pair_tables(), places=True)
    error = _softmax(hidden @ model.dense + model.offset)
    error[np.arange(len(labels)), labels] -= 1
    error /= len(labels)
    back = (error @ model.dense.T) * (hidden > 0)
    rows, out = np.arange(len(batch)), []
    for i, width in enumerate(WIDTHS):
        for k in range(width):
            grad = np.empty((FILTERS, 256), np.float32)
            for f in range(FILTERS):
                c = i * FILTERS + f
                grad[f] = np.bincount(batch[rows, where[:, c] + k], back[:, c], 256)
            out.append(grad)
    return [*out, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]


def train(
    docs: DataFrame, learn_from: Column, per_language: int = TRAIN_DOCS
) -> Model | None:
    """A model of the labels of the rows that ``learn_from`` admits; None where
    no such row has a text with a letter and a label.

    Two passes: counts by label, then a sample by the hash of the id, about
    ``per_language`` documents of each label and TRAIN_WINDOWS windows of each.
    Of more than MOST_LANGUAGES labels the commonest are learnt, the first by
    name of equally common ones; documents with others teach nothing and are
    given the label of a learnt one. Equal rows are equally likely to be drawn,
    and null texts and labels teach nothing.
    """
    known = docs.select("doc_id", "text", "lang").filter(
        learn_from & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    commonest = known.groupBy("lang").count().orderBy(F.desc("count"), "lang")
    counts = commonest.limit(MOST_LANGUAGES).collect()
    if not counts:
        return None
    languages = sorted(row["lang"] for row in counts)
    keep = {r["lang"]: min(1.0, per_language / r["count"]) * HASH_STEPS for r in counts}
    table = F.create_map(*[F.lit(x) for k, v in keep.items() for x in (k, int(v) + 1)])
    drawn = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(HASH_STEPS))

    @giving_back
    def cut(batches):
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for part in slices(batch.column("text")):
                windows, rows, lengths = windows_of(part)
                # A text's first windows at random places, the same in every run.
                rng = np.random.default_rng(len(part.data))
                order = np.lexsort((rng.random(len(rows)), rows))
                at = np.arange(len(rows)) - np.searchsorted(rows, rows[order])
                chosen = order[at < TRAIN_WINDOWS]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([windows[i].tobytes() for i in chosen], pa.binary()),
                        pa.array([langs[part.first + rows[i]] for i in chosen]),
                    ],
                    names=["window", "lang"],
                )

    sample = (
        known.filter(drawn < table[F.col("lang")])
        .select("text", "lang")
        .mapInArrow(cut, "window binary, lang string")
        .orderBy(F.xxhash64("window"), "window", "lang")
        .limit(2 * per_language * TRAIN_WINDOWS * len(languages))
        .toArrow()
    )
    windows = np.frombuffer(b"".join(sample.column("window").to_pylist()), np.uint8)
    index = {lang: i for i, lang in enumerate(languages)}
    labels = np.array([index[x] for x in sample.column("lang").to_pylist()])
    return fit(windows.reshape(-1, WINDOW), labels, languages)


def predict(
    docs: DataFrame,
    model: Model | None,
    keep: list[str],
    language: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """Columns ``keep`` of every row with its language and a score in 0 to 1: the
    mean probability over all windows of the whole text, each weighed by its
    bytes. A text that is null or without a letter is UNDETERMINED with score 0,
    and so is every text if there is no model; of equal scores the first
    language by name wins.
    """
    text = F.col("text")
    has_letter = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(*keep, F.when(has_letter, text))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])

    @giving_back
    def run(batches):
        tables = model and model.pair_tables()
        for batch in batches:
            names = np.full(batch.num_rows, UNDETERMINED, object)
            scores = np.zeros(batch.num_rows)
            texts = batch.column(len(keep))
            for part in slices(texts) if model else ():
                windows, rows, lengths = windows_of(part)
                if not len(rows):
                    continue
                chance = model.probabilities(windows, tables) * lengths[:, None]
                total = np.zeros((len(part.starts), len(model.languages)))
                np.add.at(total, rows, chance)
                size = (part.ends - part.starts)[:, None]
                total = np.divide(total, size, out=total, where=size > 0)
                found = np.flatnonzero(size[:, 0] > 0)
                best = total[found].argmax(axis=1)
                names[part.first + found] = np.array(model.languages, object)[best]
                scores[part.first + found] = np.clip(total[found, best], 0, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(names, pa.string()), pa.array(scores)],
                names=[*keep, language, score],
            )

    return rows.mapInArrow(run, f"{schema}, `{language}` string, `{score}` double")


HELD_OUT_MOD = 5


def document_languages(docs: DataFrame) -> DataFrame:
    """The predicted language of every document, learnt from those whose crc32
    remainder is not 0 (a missing id counts as remainder 0).

    Null and empty texts and those without a letter are UNDETERMINED; a null
    label teaches nothing; repeated rows are documents of their own, and a text
    of any length is read whole. No rows give no rows.
    """
    held_out = remainder("doc_id", HELD_OUT_MOD) == 0
    rows = docs.select(F.col("doc_id").cast("bigint"), "text", "lang")
    model = train(rows, ~held_out)
    found = predict(rows, model, ["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
