"""Spelling variants: words one edit apart, grouped under their commonest form.

A word is a point: how often each letter occurs in it. One edit moves the point
little: a replaced letter takes one away and adds one, a further letter adds
one. So near words are found by range searches in k-d trees over these points,
for each length the words of that length and those one longer, and only what the
search lets through is compared letter by letter.

A tree over a bounded sample deals the words of each length into cells. A word
goes as a question to every cell whose side of each split it may reach, and in
the cell's task a second tree, over that cell's own words, answers all questions
of a batch at once. Both trees only prune: any sample gives the same result.
"""

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dialtrail.operators.repeat import shuffle_partitions
from dialtrail.operators.staging import staged

RUNS = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Every 199th checksum names a letter to leave out, for words misspelt on purpose.
LEFT_OUT_MOD = 199
SHORTEST = 6
FEWEST = 5
FORM_RATIO = 5

# Axes of a point: a to z, U+00C0 to U+00FF, all other characters together.
AXES = 26 + 64 + 1
MOST_OF_A_LETTER = 255  # a point's numbers stop there, which prunes less

# The dealing tree is fitted on so many words of the vocabulary at most.
SAMPLE = 1 << 17
# Longer words are left to the blocks below, so that the sample stays small.
SAMPLED_LENGTH = 256
# Words that one cell holds about, fewer if long. A cell of over BLOCK_CELLS
# times that is cut into blocks, and its questions go to all of them.
CELL_WORDS = 4_096
CELL_LETTERS = 1 << 20
BLOCK_CELLS = 4
LEAF_WORDS = 8
# Questions, questions times tree nodes, and letters compared, held at once.
ASKED = 1 << 11
FRONTIER = 1 << 16
COMPARED = 1 << 21


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all whole texts and how often they occur.

    Runs of letters, A-Z lowered; where the checksum of doc_id and run says so,
    without one letter. A null doc_id counts as the empty text in the checksum.
    A run that occurs n times in a text is looked at once for each occurrence,
    where it lies, and merged before it is shuffled.
    """
    run = F.explode(F.regexp_extract_all("text", F.lit(RUNS), F.lit(0)))
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("bigint").cast("string"), F.lit("")).alias("id"),
        F.translate("text", UPPER, LOWER).alias("text"),
    ).select("id", run.alias("run"))
    checked = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    out = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(
        F.substring("run", F.lit(1), out), F.substring("run", out + 2, F.length("run"))
    )
    word = F.when(F.col("h") % LEFT_OUT_MOD == 0, shorter).otherwise(F.col("run"))
    return (
        checked.select(word.alias("word"))
        .filter(F.length("word") >= SHORTEST)
        .groupBy("word")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= FEWEST)
    )


def letters_of(words: np.ndarray) -> np.ndarray:
    """Code points, (words, length), of words of one length."""
    length = max(1, words.dtype.itemsize // 4)
    return np.ascontiguousarray(words).view(np.uint32).reshape(len(words), length)


def points(words: np.ndarray) -> np.ndarray:
    """(words, AXES): how often each letter occurs, for words of one length."""
    letters = letters_of(words)
    axis = np.full(letters.shape, AXES - 1, np.int64)
    plain = (letters >= ord("a")) & (letters <= ord("z"))
    axis[plain] = letters[plain] - ord("a")
    accented = (letters >= 0xC0) & (letters <= 0xFF)
    axis[accented] = letters[accented] - 0xC0 + 26
    cell = np.arange(len(words))[:, None] * AXES + axis
    counts = np.bincount(cell.ravel(), minlength=len(words) * AXES)
    return np.minimum(counts, MOST_OF_A_LETTER).astype(np.uint8).reshape(-1, AXES)


def split_of(box: np.ndarray) -> tuple[int, int] | None:
    """The axis and the number (at most it goes left) that halve points best;
    none if all are equal."""
    low, high = box.min(axis=0), box.max(axis=0)
    axes = np.flatnonzero(low < high)
    if not len(axes):
        return None
    best = None
    for axis in axes:
        counts = np.cumsum(np.bincount(box[:, axis]))[: high[axis]]
        at = int(np.abs(counts - len(box) / 2).argmin())
        off = abs(counts[at] - len(box) / 2)
        if 0 < counts[at] < len(box) and (best is None or off < best[0]):
            best = off, int(axis), at
    return best[1:] if best else None


class Tree:
    """A k-d tree as arrays. Node 0 is the root; a node with ``axis`` -1 is a
    leaf, others have children ``left`` and ``left + 1``. Each node has the box
    of its points and the range of ``order`` that they lie in."""

    def __init__(self, pts: np.ndarray, leaf: int):
        self.order = np.arange(len(pts))
        axis, cut, left, first, last, low, high = ([] for _ in range(7))
        todo = [(0, len(pts))]
        for begin, end in todo:  # grows while it is read: breadth first
            inside = pts[self.order[begin:end]]
            split = split_of(inside) if end - begin > leaf else None
            low.append(inside.min(axis=0))
            high.append(inside.max(axis=0))
            first.append(begin)
            last.append(end)
            axis.append(split[0] if split else -1)
            cut.append(split[1] if split else 0)
            left.append(len(todo) if split else 0)
            if split:
                goes_left = inside[:, split[0]] <= split[1]
                held = self.order[begin:end]
                middle = begin + int(goes_left.sum())
                self.order[begin:end] = np.concatenate([held[goes_left], held[~goes_left]])
                todo += [(begin, middle), (middle, end)]
        self.axis, self.cut, self.left = (np.array(x, np.int32) for x in (axis, cut, left))
        self.first, self.last = np.array(first), np.array(last)
        self.low, self.high = np.array(low), np.array(high)

    def reached(self, asked: np.ndarray, fewer: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(question, place in the tree's points) for all points that have at most
        one letter more and ``fewer`` letters less than the question's point. A
        box is passed by if all its points have more, or less."""
        for begin in range(0, len(asked), FRONTIER):
            some = np.arange(begin, min(begin + FRONTIER, len(asked)))
            stack = [(some, np.zeros(len(some), np.int32))]
            while stack:
                question, node = stack.pop()
                if len(question) > FRONTIER:
                    half = len(question) // 2
                    stack += [(question[half:], node[half:]), (question[:half], node[:half])]
                    continue
                point = asked[question]
                near = _within(point, self.low[node], self.high[node], fewer)
                question, node = question[near], node[near]
                ends = self.axis[node] < 0
                yield from self._leaves(question[ends], node[ends])
                question, child = question[~ends], self.left[node[~ends]]
                if len(question):
                    stack.append((np.tile(question, 2), np.concatenate([child, child + 1])))

    def _leaves(self, question, node):
        size = self.last[node] - self.first[node]
        ends = np.cumsum(size)
        at = 0
        while at < len(node):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] - size[at] + FRONTIER)))
            few = size[at:to]
            inside = np.arange(few.sum()) - np.repeat(np.cumsum(few) - few, few)
            place = self.order[np.repeat(self.first[node[at:to]], few) + inside]
            yield np.repeat(question[at:to], few), place
            at = to


def _within(point, low, high, fewer):
    """The box holds a point with at most one letter more and ``fewer`` less."""
    more = np.where(low > point, low - point, 0).sum(axis=1, dtype=np.int32)
    less = np.where(point > high, point - high, 0).sum(axis=1, dtype=np.int32)
    return (more <= 1) & (less <= fewer)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For code points of words, row by row: one letter replaced, for words of a
    length; for b one longer, one letter more."""
    n = a.shape[1]
    if b.shape[1] == n:
        return (a != b).sum(axis=1) == 1
    # Where they part, the rest of a must be the rest of b after one letter.
    same = np.cumprod(a == b[:, :n], axis=1, dtype=np.int8).astype(bool)
    return (same | (a == b[:, 1:])).all(axis=1)


def near_pairs(asked: np.ndarray, held: np.ndarray, tree: Tree) -> Iterator:
    """(question, held word) places of near words: asked ones of a length, held
    ones of that length or one longer, with the tree of the held ones' points."""
    a, b = letters_of(asked), letters_of(held)
    fewer = 1 if a.shape[1] == b.shape[1] else 0
    step = max(1, COMPARED // b.shape[1])
    asked_points, held_points = points(asked), points(held)
    for question, place in tree.reached(asked_points, fewer):
        box = held_points[place]
        close = _within(asked_points[question], box, box, fewer)
        question, place = question[close], place[close]
        for at in range(0, len(question), step):
            q, p = question[at : at + step], place[at : at + step]
            hit = one_edit(a[q], b[p])
            yield q[hit], p[hit]


def words_of_cell(length: int) -> int:
    return max(1, min(CELL_WORDS, CELL_LETTERS // max(1, length)))


class Cells:
    """The dealing tree of each length, as arrays of splits that tasks walk."""

    def __init__(self, sample: dict[int, np.ndarray], share: float):
        """``sample``: words by length; each stands for 1 / ``share`` words."""
        self.trees = {}
        for length, words in sample.items():
            leaf = max(1, math.ceil(words_of_cell(length) * share))
            tree = Tree(points(words), leaf)
            self.trees[length] = tree.axis, tree.cut, tree.left

    def own(self, pts: np.ndarray, length: int) -> np.ndarray:
        """The cell of each point."""
        node = np.zeros(len(pts), np.int64)
        if length in self.trees:
            axis, cut, left = self.trees[length]
            while (inner := axis[node] >= 0).any():
                at = node[inner]
                right = pts[inner, axis[at]] > cut[at]
                node[inner] = left[at] + right
        return node

    def reached(self, pts: np.ndarray, length: int, fewer: int):
        """(point, cell) for every cell of ``length`` where a point with at most
        one letter more and ``fewer`` less may lie: crossing a split takes one or
        the other away, and an axis that has been crossed may not be again."""
        if length not in self.trees:
            return np.arange(len(pts)), np.zeros(len(pts), np.int64)
        parts = [
            self._reached(pts[at : at + ASKED], length, fewer, at)
            for at in range(0, len(pts), ASKED)
        ]
        return tuple(map(np.concatenate, zip(*parts)))

    def _reached(self, pts, length, fewer, first):
        place = np.arange(len(pts))
        node = np.zeros(len(pts), np.int64)
        axis, cut, left = self.trees[length]
        # Bounds of the node on each axis, as far as the splits above it tell.
        low, high = np.zeros_like(pts), np.full_like(pts, MOST_OF_A_LETTER)
        out_place, out_node = [], []
        while len(place):
            ends = axis[node] < 0
            out_place.append(place[ends])
            out_node.append(node[ends])
            place, node, low, high = place[~ends], node[~ends], low[~ends], high[~ends]
            if not len(place):
                break
            on, at, row = axis[node], cut[node].astype(np.uint8), np.arange(len(place))
            left_high, right_low = high.copy(), low.copy()
            left_high[row, on] = np.minimum(left_high[row, on], at)
            right_low[row, on] = np.maximum(right_low[row, on], at + 1)
            place, node = np.tile(place, 2), np.concatenate([left[node], left[node] + 1])
            low, high = np.concatenate([low, right_low]), np.concatenate([left_high, high])
            near = _within(pts[place], low, high, fewer)
            place, node, low, high = place[near], node[near], low[near], high[near]
        return np.concatenate(out_place) + first, np.concatenate(out_node)


def by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, words) for each length among the words."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    for length, places in itertools.groupby(order.tolist(), key=sizes.__getitem__):
        at = np.fromiter(places, np.int64)
        yield int(length), at, np.array([words[i] for i in at], f"<U{length}")


def fit_cells(words: DataFrame, most: int = SAMPLE) -> Cells:
    """The dealing tree, from about ``most`` words, never twice as many, that
    come to the driver (counts the words)."""
    total = words.count()
    share = min(1.0, most / max(1, total))
    # By hash, so that a task that runs again takes the same words.
    drawn = F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))
    short = F.length("word") <= SAMPLED_LENGTH
    rows = words.select("word").filter(drawn & short).limit(2 * most).collect()
    sample = [row.word for row in rows]
    return Cells({length: held for length, _, held in by_length(sample)}, share)


DEALT = "length bigint, cell bigint, kind bigint, word string, n bigint"


def dealt_words(words: DataFrame, cells: Cells) -> DataFrame:
    """(length, cell, kind, word, n): each word once in its own cell (kind 0),
    and as a question in every cell of its length that near words may lie in
    (kind 1) and of the next length (kind 2)."""

    def run(batches):
        for batch in batches:
            word, n = batch.column("word"), batch.column("n")
            for length, at, some in by_length(word.to_pylist()):
                pts = points(some)
                every = np.arange(len(some))
                parts = [
                    (length, 0, every, cells.own(pts, length)),
                    (length, 1, *cells.reached(pts, length, 1)),
                    (length + 1, 2, *cells.reached(pts, length + 1, 0)),
                ]
                for target, kind, place, cell in parts:
                    taken = pa.array(at[place])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(place), target)),
                            pa.array(cell),
                            pa.array(np.full(len(place), kind)),
                            word.take(taken),
                            n.take(taken),
                        ],
                        ["length", "cell", "kind", "word", "n"],
                    )

    return words.select("word", "n").mapInArrow(run, DEALT)


PAIRS = "word string, n bigint, near string, near_n bigint"


def found_pairs(dealt: DataFrame) -> DataFrame:
    """(word, n, near, near_n) for each word and each word near it, from the
    staged ``dealt_words``. A cell's own words come first in its task and are
    held; its questions follow in batches of any number."""
    cell = ["length", "cell"]
    most = F.greatest(F.lit(1), F.least(F.lit(CELL_WORDS), F.lit(CELL_LETTERS) / F.col("length")))
    sizes = (
        dealt.filter(F.col("kind") == 0)
        .groupBy(*cell)
        .agg(F.count("*").alias("size"))
        .withColumn("blocks", F.ceil(F.col("size") / (most * BLOCK_CELLS)).cast("bigint"))
    )
    own_block = F.array(F.pmod(F.xxhash64("word"), F.col("blocks")))
    every_block = F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)
    block = F.explode(F.when(F.col("kind") == 0, own_block).otherwise(every_block))
    keys = [*cell, "block", "kind"]
    # The number of partitions is named: cells are little to read, much to do.
    sorted_cells = (
        dealt.join(sizes.drop("size"), cell)  # a cell without words gives no pairs
        .select(*cell, block.alias("block"), "kind", "word", "n")
        .repartition(shuffle_partitions(dealt.sparkSession), *keys[:3])
        .sortWithinPartitions(*keys)
    )
    return sorted_cells.mapInArrow(_answered, PAIRS)


def _answered(batches) -> Iterator[pa.RecordBatch]:
    current, held, tree = None, None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in ("length", "cell", "block", "kind")]
        keys = np.stack(columns)
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        for begin, end in itertools.pairwise([0, *cuts.tolist(), batch.num_rows]):
            *key, kind = keys[:, begin].tolist()
            if key != current:
                current, held, tree = key, [], None
            some = pa.table(batch.slice(begin, end - begin).select(["word", "n"]))
            if kind == 0:
                held.append(some)
                continue
            if tree is None:
                held = pa.concat_tables(held).combine_chunks() if held else some.slice(0, 0)
                if held.num_rows:
                    words = np.array(held.column("word").to_pylist(), f"<U{key[0]}")
                    tree = Tree(points(words), LEAF_WORDS)
            if held.num_rows:
                asked = np.array(some.column("word").to_pylist(), f"<U{key[0] - (kind == 2)}")
                for question, place in near_pairs(asked, words, tree):
                    if len(question):
                        near, own = some.take(pa.array(question)), held.take(pa.array(place))
                        yield _pairs(near, own)
                        if kind == 2:
                            yield _pairs(own, near)


def _pairs(words: pa.Table, near: pa.Table) -> pa.RecordBatch:
    columns = [*words.columns, *near.columns]
    return pa.RecordBatch.from_arrays(
        [c.combine_chunks() for c in columns], ["word", "n", "near", "near_n"]
    )


def with_forms(words: DataFrame, pairs: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word: its commonest near word,
    the first in code-point order of equally common ones, if that occurs at
    least ``ratio`` times as often."""
    none = {"near": F.lit(None).cast("string"), "near_n": F.lit(None).cast("bigint")}
    known = F.col("near").isNotNull()
    # Text compares by its UTF-8 bytes, which is the order of code points.
    best = F.min(F.when(known, F.struct((-F.col("near_n")).alias("minus_n"), "near")))
    grouped = (
        pairs.unionByName(words.select("word", "n").withColumns(none))
        .groupBy("word")
        .agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    )
    is_form = -F.col("best.minus_n") >= F.col("n") * ratio
    return grouped.select(
        "word",
        "n",
        "n_near",
        F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.minus_n")).alias("form_n"),
    )


def roots(formed: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """(word, root) of the words that have a form, from the staged result of
    ``with_forms`` (stages each round). A form occurs ``ratio`` times as often as
    its word, so a chain of forms is short, and each round doubles how far along
    it a word points."""
    links = formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    most, least = formed.agg(F.max("n"), F.min("n")).first()
    longest = 0  # links from a rarest word to a commonest
    while most and least * ratio ** (longest + 1) <= most:
        longest += 1
    for _ in range(max(0, longest - 1).bit_length()):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("then"))
        links = staged(
            links.join(further, "root", "left").select(
                "word", F.coalesce("then", "root").alias("root")
            ),
            "roots",
        )
    return links


def variants(words: DataFrame) -> DataFrame:
    """Each word of (word, n) with its near words' number, its form and its root
    (stages data). Words are distinct and not null; none give no rows."""
    words = staged(words, "words")
    dealt = staged(dealt_words(words, fit_cells(words)), "dealt")
    formed = staged(with_forms(words, found_pairs(dealt)), "formed")
    linked = formed.join(roots(formed), "word", "left")
    return linked.select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        "n_near",
        "form_n",
    )


def word_variants(docs: DataFrame) -> DataFrame:
    """Spelling variants among the words of all ``docs``. Null and empty texts
    have no words, equal rows each count, columns other than doc_id and text are
    not looked at, and no documents give no rows."""
    return variants(word_counts(docs))
