"""Score texts by prediction by partial matching over bytes, pretrained.

Training counts every byte with the ORDER bytes before it, over all training
texts; shorter contexts are sums of longer ones. The counts stay in tables and
nothing is left out of them. At most MOST_HEAD_GRAMS of the commonest grams are
broadcast with their chances; the texts' other grams meet theirs in joins, level
by level down to LOW, whose contexts are so short that the alphabet bounds them.

On request ``train`` makes a trie of bounded size instead: the nodes whose share
of all training bytes is at least 1 / ``most_nodes``. What a context's left-out
successors were seen is known exactly and goes to the escape.

A byte is predicted from the longest known context. There a context with T seen
successors, D of them different, and R left out (0 in the whole tables) gives

    (2 count - 1) / 2(T + R) to a known successor, (D + 2R) / 2(T + R) to an escape,

and after an escape the next shorter context is asked, with the successors that
the longer one offered excluded from all of its counts. Below the shortest one
all symbols not yet excluded are alike. The end of a text is a symbol of its own
(0xFF, which no UTF-8 text holds), and a text begins after as many of them as a
context has, so the probabilities of all texts add up to one.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dialtrail.llm.langid import remainder
from dialtrail.llm.texts import Hashes, slices, word_bounds
from dialtrail.operators.staging import staged

ORDER = 6
MOST_NODES = 1 << 20
# Grams looked up where the texts lie, and the context length up to which whole
# levels of the trie are.
MOST_HEAD_GRAMS = 1 << 21
LOW = 2
END = 0xFF
SYMBOLS = 256
CACHE_BITS = 21
KEYS_HELD = 3_000_000  # by a task before it sums them
# Words whose share of all training tokens is at least 1 / MOST_HEAD_WORDS are
# looked up where the texts lie; the others meet their texts in a join.
MOST_HEAD_WORDS = 1 << 21
END_WORD = 0  # no word hashes to 0


def byte_grams(part) -> np.ndarray:
    """For every byte of every text and its end: the ORDER bytes before it and
    itself, as one number of ORDER + 1 bytes; texts end to end."""
    sizes = part.ends - part.starts
    rows = np.arange(len(sizes))
    # Each text is followed by ORDER ends: its own, and the next one's context.
    data = np.full(len(part.data) + ORDER * (len(sizes) + 1), END, np.uint8)
    at = np.arange(len(part.data)) + ORDER * (np.repeat(rows, sizes) + 1)
    data[at] = part.data
    # Eight bytes from every place on, the last ORDER + 1 of them kept.
    padded = np.concatenate([np.zeros(7 - ORDER, np.uint8), data])
    eight = np.ndarray(len(data) - ORDER, ">u8", padded, strides=(1,))
    grams = (eight.astype(np.uint64) & np.uint64((1 << 8 * (ORDER + 1)) - 1)).view(np.int64)
    first = part.starts + ORDER * rows
    keep = np.zeros(len(grams) + 1, np.int64)
    np.add.at(keep, first, 1)
    np.add.at(keep, first + sizes + 1, -1)
    return grams[np.cumsum(keep[:-1]) > 0]


def count_grams(docs: DataFrame) -> DataFrame:
    """(gram, n) of all texts, summed as far as a task's buffer reaches."""
    return _counted(docs, byte_grams, "gram")


def _counted(docs: DataFrame, keys_of, name: str) -> DataFrame:
    def run(batches):
        keys, counts, held = [], [], 0
        for batch in batches:
            for part in slices(batch.column("text")):
                key, n = np.unique(keys_of(part), return_counts=True)
                keys.append(key)
                counts.append(n)
                held += len(key)
                if held > KEYS_HELD:
                    merged, total = _summed(keys, counts)
                    keys, counts, held = [merged], [total], len(merged)
                    if held > KEYS_HELD // 2:
                        yield _counts_batch(merged, total, name)
                        keys, counts, held = [], [], 0
        if held:
            yield _counts_batch(*_summed(keys, counts), name)

    return docs.select("text").mapInArrow(run, f"{name} bigint, n bigint")


def _summed(keys, counts):
    merged, which = np.unique(np.concatenate(keys), return_inverse=True)
    return merged, np.bincount(which, np.concatenate(counts)).astype(np.int64)


def _counts_batch(keys, counts, name):
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=[name, "n"])


@dataclass
class Level:
    """Contexts of one length, sorted, with their totals, and the pairs of a
    context and a successor, sorted, with their counts."""

    contexts: np.ndarray
    total: np.ndarray  # of the successors in the trie
    kinds: np.ndarray  # how many those are
    left_out: np.ndarray
    taken_total: np.ndarray  # what the next shorter context gives the same successors
    pairs: np.ndarray
    counts: np.ndarray


def _find(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_keys, keys), max(0, len(sorted_keys) - 1))
    return at, sorted_keys[at] == keys if len(sorted_keys) else np.zeros(len(keys), bool)


class Trie:
    """``nodes[j]``: (pairs, counts) of contexts of j bytes with a successor,
    complete but for nodes under the threshold; ``seen[j]``: how often each
    context of j bytes was followed by anything at all."""

    def __init__(self, pairs: list[np.ndarray], counts: list[np.ndarray], total: int):
        self.levels: list[Level] = []
        for j, (p, n) in enumerate(zip(pairs, counts)):
            contexts, which = np.unique(p >> 8, return_inverse=True)
            in_trie = np.bincount(which, n, len(contexts)).astype(np.int64)
            kinds = np.bincount(which, minlength=len(contexts))
            # A context is followed as often as it is seen as a pair of the level
            # below: each text has an end.
            seen = self._seen(j, contexts, in_trie, total)
            taken = np.zeros(len(contexts), np.int64)
            if j:
                shorter = self.levels[j - 1]
                shorter_pair = p & ((1 << 8 * j) - 1)
                at, found = _find(shorter.pairs, shorter_pair)
                taken = np.bincount(
                    which, np.where(found, shorter.counts[at], 0), len(contexts)
                ).astype(np.int64)
            self.levels.append(
                Level(contexts, in_trie, kinds, np.maximum(seen - in_trie, 0), taken, p, n)
            )

    def _seen(self, j, contexts, in_trie, total):
        if j == 0:
            return np.full(len(contexts), total)
        above = self.levels[j - 1]
        at, found = _find(above.pairs, contexts)
        followed = np.where(found, above.counts[at], in_trie)
        # A context of ends alone is seen before each text; there are as many ends.
        bottom = self.levels[0]
        at, found = _find(bottom.pairs, np.array([END]))
        texts = bottom.counts[at[0]] if found[0] else 0
        padding = contexts == (1 << 8 * j) - 1
        return np.where(padding, texts, followed)

    def log10(self, grams: np.ndarray, total_off=0, kinds_off=0) -> np.ndarray:
        """log10 probability of each gram's last byte after the bytes before."""
        out = np.zeros(len(grams))
        todo = np.arange(len(grams))
        # What is excluded by the longer context that was escaped from.
        total_off = np.zeros(len(grams), np.int64) + total_off
        kinds_off = np.zeros(len(grams), np.int64) + kinds_off
        for j in range(len(self.levels) - 1, -1, -1):
            if not len(todo):
                break
            level = self.levels[j]
            gram = grams[todo] & ((1 << 8 * (j + 1)) - 1)
            at, known = _find(level.contexts, gram >> 8)
            rows, gram, at = todo[known], gram[known], at[known]
            if not len(rows):
                continue
            total = level.total[at] - total_off[rows]
            kinds = level.kinds[at] - kinds_off[rows]
            escape = kinds + 2 * level.left_out[at]
            # With nothing left to offer, the escape is certain.
            live = kinds > 0
            whole = np.where(live, 2 * (total + level.left_out[at]), 1)
            pair_at, found = _find(level.pairs, gram)
            hit = found & live
            out[rows[hit]] += np.log10((2 * level.counts[pair_at[hit]] - 1) / whole[hit])
            miss = ~found
            lost = miss & live
            out[rows[lost]] += np.log10(escape[lost] / whole[lost])
            total_off[rows] = level.taken_total[at]
            kinds_off[rows] = level.kinds[at]
            done = np.zeros(len(grams), bool)
            done[rows[found]] = True
            todo = todo[~done[todo]]
        if len(todo):
            out[todo] -= np.log10(SYMBOLS - kinds_off[todo])
        return out


class Head:
    """The commonest grams with their log10 probabilities; NaN for any other."""

    def __init__(self, grams: np.ndarray, values: np.ndarray):
        order = np.argsort(grams)
        self.grams, self.values = grams[order], values[order]

    def log10(self, grams: np.ndarray) -> np.ndarray:
        out = np.full(len(grams), np.nan)
        at, found = _find(self.grams, grams)
        out[found] = self.values[at[found]]
        return out


def _level(longer: DataFrame, j: int) -> DataFrame:
    """The pairs with contexts of j bytes, of those with longer contexts."""
    pair = F.col("gram").bitwiseAND(F.lit((1 << 8 * (j + 1)) - 1))
    return longer.groupBy(pair.alias("gram")).agg(F.sum("n").alias("n"))


class Tables:
    """Every pair of a context and a successor with its count, in a staged table
    for each length of contexts. ``local`` is the part for the texts' tasks."""

    def __init__(self, grams: DataFrame):
        context = F.shiftright("gram", 8)
        self.levels = {ORDER: grams}
        for j in range(ORDER - 1, LOW - 1, -1):
            self.levels[j] = staged(_level(self.levels[j + 1], j), f"level{j}")
        seen = grams.groupBy(context.alias("context")).agg(F.sum("n").alias("total"))
        chance = F.log10((2 * F.col("n") - 1) / (2 * F.col("total")))
        self.known = staged(
            grams.withColumn("context", context)
            .join(seen, "context")
            .select("gram", "n", chance.alias("value")),
            "known",
        )
        head = self.known.filter(F.col("n") >= self._least()).toArrow()
        self.local = Head(head.column("gram").to_numpy(), head.column("value").to_numpy())
        low = [self.levels[LOW]]
        for j in range(LOW - 1, -1, -1):
            low.insert(0, _level(low[0], j))
        pairs, counts = [], []
        for level in low:  # at most 256 ** (LOW + 1) pairs
            table = level.toArrow()
            pair = table.column("gram").to_numpy()
            order = np.argsort(pair)
            pairs.append(pair[order])
            counts.append(table.column("n").to_numpy()[order])
        self.low = Trie(pairs, counts, int(counts[0].sum()))

    def _least(self) -> int:
        """A count that at most MOST_HEAD_GRAMS grams reach."""
        step = F.ceil(F.log2("n") * 8)
        sizes = self.known.groupBy(step.alias("step")).count().collect()  # some hundred rows
        least, held = 1 << 62, 0
        for row in sorted(sizes, key=lambda r: -r["step"]):
            held += row["count"]
            if held > MOST_HEAD_GRAMS:
                break
            # Above the step before: its counts are n <= 2 ** ((step - 1) / 8).
            least = int(2 ** ((row["step"] - 1) / 8)) + 1 if row["step"] else 1
        return least

    def log10(self, grams: DataFrame) -> DataFrame:
        """(gram, value) of different grams: log10 of their probability."""
        hits = grams.join(self.known.select("gram", "value"), "gram")
        zero = F.lit(0).cast("bigint")
        state = staged(
            grams.join(self.known, "gram", "left_anti").select(
                "gram",
                F.lit(0.0).alias("value"),
                zero.alias("total_off"),
                zero.alias("kinds_off"),
                F.lit(False).alias("done"),
            ),
            "escapes",
        )
        for j in range(ORDER, LOW, -1):
            state = staged(self._escaped(state, j), "escapes")
        low = grams.sparkSession.sparkContext.broadcast(self.low)

        def run(batches):
            for batch in batches:
                gram, value, total_off, kinds_off, done = (c.to_numpy(False) for c in batch.columns)
                todo = ~done
                value = value.copy()
                value[todo] += low.value.log10(gram[todo], total_off[todo], kinds_off[todo])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("gram"), pa.array(value)], names=["gram", "value"]
                )

        return hits.unionByName(state.mapInArrow(run, "gram bigint, value double"))

    def _escaped(self, state: DataFrame, j: int) -> DataFrame:
        """``state`` after contexts of j bytes were asked, as in ``Trie.log10``."""
        pair = F.col("gram").bitwiseAND(F.lit((1 << 8 * (j + 1)) - 1))
        # What is done asks for a number of its own that no context has.
        nothing = -1 - F.col("gram")
        asked = state.withColumn("pair", F.when(F.col("done"), nothing).otherwise(pair))
        asked = asked.withColumn("context", F.shiftright("pair", 8))
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * j) - 1))
        below = self.levels[j - 1].select(F.col("gram").alias("shorter"), F.col("n").alias("m"))
        contexts = (
            self.levels[j]
            .select("n", F.shiftright("gram", 8).alias("context"), shorter.alias("shorter"))
            .join(asked.filter(~F.col("done")).select("context").distinct(), "context", "left_semi")
            .join(below, "shorter")
            .groupBy("context")
            .agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.sum("m").alias("taken"))
        )
        pairs = self.levels[j].select(F.col("gram").alias("pair"), "n")
        total, kinds = F.col("total") - F.col("total_off"), F.col("kinds") - F.col("kinds_off")
        # With nothing left to offer, the escape is certain.
        part = F.coalesce(2 * F.col("n") - 1, kinds) / (2 * total)
        step = F.when(kinds > 0, F.log10(part)).otherwise(0.0)
        return (
            asked.join(contexts, "context", "left")
            .join(pairs, "pair", "left")
            .select(
                "gram",
                (F.col("value") + step).alias("value"),
                F.coalesce("taken", "total_off").alias("total_off"),
                F.coalesce("kinds", "kinds_off").alias("kinds_off"),
                (F.col("done") | F.col("n").isNotNull()).alias("done"),
            )
        )


class Scorer:
    """A trie or head with a direct-mapped store of what it said of common grams."""

    def __init__(self, trie: Trie | Head):
        self.trie = trie
        self.keys = np.full(1 << CACHE_BITS, -1, np.int64)
        self.values = np.zeros(1 << CACHE_BITS)

    def log10(self, grams: np.ndarray) -> np.ndarray:
        spread = grams.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        slot = (spread >> np.uint64(64 - CACHE_BITS)).astype(np.int64)
        out = self.values[slot]
        miss = np.flatnonzero(self.keys[slot] != grams)
        if len(miss):
            new, which = np.unique(grams[miss], return_inverse=True)
            value = self.trie.log10(new)
            out[miss] = value[which]
            self.keys[slot[miss]] = grams[miss]
            self.values[slot[miss]] = out[miss]
            # Of two that share a slot the later stays: both arrays agree on it.
        return out


def train(docs: DataFrame, most_nodes: int | None = None) -> Trie | Tables:
    """The counts of all texts of ``docs``, in tables (stages data). Nulls count
    as empty texts. With ``most_nodes``, a trie without rarer nodes: at most so
    many pairs for each of ORDER + 1 lengths.

    Counts are gathered by a shuffle and grow with the corpus; what reaches the
    driver is bounded either way.
    """
    grams = staged(
        count_grams(docs).groupBy("gram").agg(F.sum("n").alias("n")), "grams"
    )
    if most_nodes is None:
        return Tables(grams)
    total = grams.agg(F.sum("n")).first()[0] or 0
    least = max(1, -(-total // most_nodes))
    pairs, counts, level = [], [], grams
    for j in range(ORDER, -1, -1):
        mask = F.lit((1 << 8 * (j + 1)) - 1)
        if j < ORDER:
            level = (
                grams.select(F.col("gram").bitwiseAND(mask).alias("gram"), "n")
                .groupBy("gram")
                .agg(F.sum("n").alias("n"))
            )
        kept = level.filter(F.col("n") >= least).toArrow()
        pair = kept.column("gram").to_numpy()
        order = np.argsort(pair)
        pairs.insert(0, pair[order])
        counts.insert(0, kept.column("n").to_numpy()[order])
    return Trie(pairs, counts, total)


def _rows(part, values: np.ndarray) -> np.ndarray:
    """Sums by text of values for each of its bytes and its end."""
    sizes = part.ends - part.starts + 1
    ends = np.cumsum(sizes)
    sums = np.concatenate([[0.0], np.cumsum(values)])
    return sums[ends] - sums[ends - sizes]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): hashes of the lower-cased words of all texts, END_WORD once a
    text, summed as far as a task's buffer reaches."""

    def keys(part):
        return np.append(_words(part)[0], np.full(len(part.starts), END_WORD))

    return _counted(docs, keys, "word")


def _words(part) -> tuple[np.ndarray, np.ndarray]:
    low = part.lowered()
    starts, ends, rows = word_bounds(low)
    if not len(starts):
        return np.zeros(0, np.int64), rows
    words = Hashes(low.data).of(starts, ends).view(np.int64)
    return np.where(words == END_WORD, 1, words), rows


SCORED = "row bigint, doc_id bigint, n_words bigint, n_head bigint, head double, score double"
TAIL = ", word bigint, gram bigint, n bigint"


def score_documents(docs: DataFrame, held_out: Column | None = None) -> DataFrame:
    """Scores of all texts, learnt from those where ``held_out`` is false (stages
    data); by default a tenth, by the crc32 of the id, is held out.

    A null text is empty: its one token is the end. A missing id counts as
    remainder 0. Equal rows are scored each. With nothing to learn from, N and V
    are 0 and every byte is as likely as another. No rows give no rows.
    """
    if held_out is None:
        held_out = remainder("doc_id", 10) == 0
    rows = docs.select(
        F.col("doc_id").cast("bigint"), "text", held_out.alias("held_out")
    )
    learnt = rows.filter(~F.col("held_out"))
    words = staged(word_counts(learnt).groupBy("word").agg(F.sum("n").alias("n")), "words")
    tokens, distinct, ends = words.agg(
        F.coalesce(F.sum("n"), F.lit(0)),
        F.count("*"),
        F.coalesce(F.sum(F.when(F.col("word") == END_WORD, F.col("n"))), F.lit(0)),
    ).first()
    least = max(1, -(-tokens // MOST_HEAD_WORDS))
    head = words.filter(F.col("n") >= least).toArrow()  # at most MOST_HEAD_WORDS
    order = np.argsort(head.column("word").to_numpy())
    context = docs.sparkSession.sparkContext
    model = train(learnt)
    shared = context.broadcast(
        (
            model if isinstance(model, Trie) else model.local,
            head.column("word").to_numpy()[order],
            head.column("n").to_numpy()[order],
        )
    )

    def run(batches) -> Iterator[pa.RecordBatch]:
        trie, head_words, head_counts = shared.value
        scorer = Scorer(trie)
        for batch in batches:
            ids = batch.column("row")
            names = batch.column("doc_id")
            for part in slices(batch.column("text")):
                size = len(part.starts)
                grams = byte_grams(part)
                chance = scorer.log10(grams)
                rare = np.isnan(chance)
                score = _rows(part, np.where(rare, 0.0, chance))
                of_row = np.repeat(np.arange(size), part.ends - part.starts + 1)
                own, at_row = _words(part)
                at, found = _find(head_words, own)
                value = np.log10(head_counts[at[found]] + 0.1) if found.any() else []
                n_words = np.bincount(at_row, minlength=size)
                n_head = np.bincount(at_row[found], minlength=size)
                sums = np.bincount(at_row[found], value, size).astype(float)
                first = [
                    ids.slice(part.first, size),
                    names.slice(part.first, size),
                    *map(pa.array, (n_words, n_head, sums, score)),
                    *[pa.nulls(size, pa.int64())] * 3,
                ]
                fields = ["row", "doc_id", "n_words", "n_head", "head", "score"]
                fields += ["word", "gram", "n"]
                yield pa.RecordBatch.from_arrays(first, names=fields)
                # Words and grams outside the heads, once for each text they are in.
                for column, tail, n in (
                    (6, *_distinct(at_row[~found], own[~found])),
                    (7, *_distinct(of_row[rare], grams[rare])),
                ):
                    kept = pa.array(part.first + tail[0])
                    nothing = pa.nulls(len(n), pa.int64())
                    columns = [ids.take(kept), names.take(kept), nothing, nothing]
                    columns += [pa.nulls(len(n), pa.float64())] * 2 + [nothing] * 2 + [pa.array(n)]
                    columns[column] = pa.array(tail[1])
                    yield pa.RecordBatch.from_arrays(columns, names=fields)

    numbered = rows.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text"
    )
    scored = staged(numbered.mapInArrow(run, SCORED + TAIL), "scored")
    rare = (
        scored.filter(F.col("word").isNotNull())
        .select("row", "word", "n")
        .join(words.withColumnRenamed("n", "c").filter(F.col("c") < least), "word")
        .groupBy("row")
        .agg(
            F.sum("n").alias("n_rare"),
            F.sum(F.col("n") * F.log10(F.col("c") + 0.1)).alias("rare"),
        )
    )
    scores = scored.filter(F.col("n_words").isNotNull())
    score = F.col("score")
    if isinstance(model, Tables):
        tail = scored.filter(F.col("gram").isNotNull()).select("row", "gram", "n")
        chances = model.log10(tail.select("gram").distinct())
        sums = (
            tail.join(chances, "gram")
            .groupBy("row")
            .agg(F.sum(F.col("n") * F.col("value")).alias("rare_grams"))
        )
        scores = scores.join(sums, "row", "left")
        score += F.coalesce("rare_grams", F.lit(0.0))
    whole = tokens + 0.1 * (distinct + 1)
    n_known = F.col("n_head") + F.coalesce("n_rare", F.lit(0))
    unknown = F.col("n_words") - n_known
    base = (
        F.col("head")
        + F.coalesce("rare", F.lit(0.0))
        + unknown * float(np.log10(0.1))
        + float(np.log10(ends + 0.1))
        - (F.col("n_words") + 1) * float(np.log10(whole))
    )
    return (
        scores.join(rare, "row", "left")
        .select(
            "doc_id",
            (remainder("doc_id", 10) == 0).alias("held_out"),
            (F.col("n_words") + 1).alias("n_tokens"),
            (n_known + int(ends > 0)).alias("n_known"),
            F.lit(int(tokens)).cast("bigint").alias("train_tokens"),
            base.alias("base_score"),
            score.alias("score"),
        )
    )


def _distinct(rows: np.ndarray, words: np.ndarray):
    """Each word of each row once, with how often it is there."""
    order = np.lexsort((words, rows))
    rows, words = rows[order], words[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (words[1:] != words[:-1])
    at = np.flatnonzero(new)
    return (rows[at], words[at]), np.diff(np.append(at, len(rows)))

