"""Class-based n-gram scoring: words get classes by exchange clustering, texts are scored by class bigrams.

P(word | before) = P(class of word | class of word before) * P(word | its class), both smoothed.
Counts of words and of pairs of neighbours cover the whole training corpus. All words of at least ``least``
occurrences are clustered (up to the ``known`` most frequent, which every scoring task holds), so their
number grows with the corpus. Pairs of neighbours are a table; each sweep of the exchange deals the words by
rank over numbered batches with their neighbours' counts. A batch has the grid of class pairs, takes one of its words after
the other out of its class and puts it where the likelihood of the class pairs is greatest; then the grid is counted anew
from all batches' moves. Where these together don't raise the likelihood, those of half of the batches are taken, of a
quarter and so on. A sweep that raises the likelihood by less than the share ``settled`` ends the exchange. Batches follow from the words alone, so classes
and scores are the same however the texts are cut into tasks.
A rarer word's class follows from its shape (length and closing punctuation), so words never seen have one
too. Counts of all words are joined to the texts: those of the ``known`` most frequent go to every task, the
rest by shuffle, where no key is frequent.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, table

#: Token that ends every text; no word is white space.
END = "\n"
_CLOSING = ".,;:!?"
_LENGTHS = 15
SHAPES = 2 * (_LENGTHS + 1)


@dataclass(frozen=True)
class Params:
    least: int = 5
    classes: int = 64
    sweeps: int = 8
    settled: float = 0.005
    known: int = 150_000
    lead: int = 1024
    batch: int = 1024
    alpha: float = 0.5


@dataclass(frozen=True)
class Model:
    """``counts`` has (word, c) of every training word; ``known`` the most frequent, ``classes`` those of the clustered words."""

    counts: DataFrame
    known: dict[str, int]
    classes: dict[str, int]
    shapes: int
    transition: np.ndarray
    emission: np.ndarray
    tokens: int
    types: int
    ends: int


def shape(word: bytes) -> int:
    """Number of a word's shape: its length in bytes and whether it closes with punctuation."""
    return 2 * min(_LENGTHS, len(word)) + (word[-1:] in (b".", b",", b";", b":", b"!", b"?"))


def shape_column(word: Column) -> Column:
    return 2 * F.least(F.lit(_LENGTHS), F.octet_length(word)) + F.substring(word, -1, 1).isin(*_CLOSING).cast("int")


class Numbers(dict):
    """The given numbers of words; any other word's is ``first`` plus that of its shape."""

    def __init__(self, number: dict[str, int], first: int):
        super().__init__({w.encode(): n for w, n in number.items()})
        self.first, self.base = first, len(self)

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.base + 300_000:
            for w in list(self)[self.base :]:
                del self[w]
        out = self[word] = self.first + shape(word)
        return out


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def word_counts(texts: DataFrame, room: int = 300_000) -> DataFrame:
    """(word, c) of every word of the column ``t``. A task hands on what it has counted whenever that is ``room`` words."""

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            words, n = list(held), np.fromiter(held.values(), np.int64, len(held))
            held.clear()
            for i in range(0, len(words), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(words[i : i + 50_000], pa.binary()).cast(pa.string()), pa.array(n[i : i + 50_000])], names=["word", "c"])

        for part in parts:
            for text in part.column(0).to_pylist():
                held.update(_words(text))
                if len(held) > room:
                    yield from out()
        yield from out()

    return texts.select("t").mapInArrow(counted, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


#: Neighbour lists are packed: places and counts as unsigned 32-bit integers in the columns ``at`` and ``n`` of a side.
PACKED = "w int, after_at binary, after_n binary, before_at binary, before_n binary"
_MOST = np.int64((1 << 32) - 1)


def _packed(keys: np.ndarray, sides: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """A row for each of the sorted ``keys``, from (key, other, n) of both sides, each sorted by key."""
    columns = [pa.array(keys, pa.int32())]
    for key, other, n in sides:
        for x in (other, n):
            ends = np.concatenate([np.searchsorted(key, keys), [len(key)]]).astype(np.int32) * 4
            columns.append(pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(ends), pa.py_buffer(x.astype("<u4"))]))
    return pa.RecordBatch.from_arrays(columns, names=["w", "after_at", "after_n", "before_at", "before_n"])


def _side(part: pa.RecordBatch, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds of each row's list, others, counts) of a packed side."""
    out = []
    for k in ("at", "n"):
        column = part.column(part.schema.get_field_index(f"{side}_{k}"))
        bounds = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1] // 4
        data = column.buffers()[2]
        out.append(np.frombuffer(data, "<u4") if data is not None and data.size else np.zeros(0, "<u4"))
    return bounds, out[0], out[1]


def _long(part: pa.RecordBatch, side: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(w, other, n) of every entry of a packed side."""
    bounds, other, n = _side(part, side)
    first, last = int(bounds[0]), int(bounds[-1])
    return np.repeat(part.column(0).to_numpy().astype(np.int64), np.diff(bounds)), other[first:last].astype(np.int64), n[first:last].astype(np.int64)


def _summed(w: np.ndarray, other: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted by (w, other), a pair once; a count too large for its field is split over entries."""
    code = w << 32 | other
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
    code, n = code[first], np.add.reduceat(n, first) if len(first) else n
    parts = -(-n // _MOST)
    if (parts > 1).any():
        rest = n - (parts - 1) * _MOST
        code, n = np.repeat(code, parts), np.full(int(parts.sum()), _MOST)
        n[np.cumsum(parts) - 1] = rest
    return code >> 32, code & 0xFFFFFFFF, n


def _both(sides: list[tuple[np.ndarray, np.ndarray, np.ndarray]], rows: int = 5000) -> Iterator[pa.RecordBatch]:
    keys = np.unique(np.concatenate([sides[0][0], sides[1][0]]))
    for i in range(0, len(keys), rows):
        some = keys[i : i + rows]
        cut = [slice(np.searchsorted(s[0], some[0]), np.searchsorted(s[0], some[-1], "right")) for s in sides]
        yield _packed(some, [tuple(x[c] for x in s) for s, c in zip(sides, cut)])


def neighbour_counts(texts: DataFrame, symbol: dict[str, int], room: int = 2_000_000, hot: int = 512, spread: int = 16) -> DataFrame:
    """(w, lists): how often each symbol is followed and preceded by each other one, as a written table of a row each.

    The end is 0, clustered words follow by falling frequency, then the shapes; each text begins after an end. A task
    counts ``room`` pairs or so at a time and hands them on packed by symbol. The lists of the ``hot`` most frequent words,
    the end and the shapes are first merged in ``spread`` parts; a merged list is bounded by the number of symbols.
    """
    first = len(symbol) + 1

    def counted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, held, size = Numbers(symbol, first), [], 0

        def out() -> Iterator[pa.RecordBatch]:
            pair, n = np.unique(np.concatenate(held), return_counts=True)
            a, b = pair >> 32, pair & 0xFFFFFFFF
            yield from _both([(a, b, n), _summed(b, a, n)])

        for part in parts:
            ids = [np.zeros(1, np.int64)]
            for text in part.column(0).to_pylist():
                words = _words(text)
                ids += [np.fromiter(map(of.__getitem__, words), np.int64, len(words)), ids[0]]
            x = np.concatenate(ids)
            held.append(x[:-1] << 32 | x[1:])
            size += len(x)
            if size > room:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    def merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def out(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sides = [[np.concatenate(x) for x in zip(*(_long(p, side) for p in batches))] for side in ("after", "before")]
            yield from _both([_summed(*x) for x in sides])

        for part in parts:
            w = part.column(0).to_numpy()
            cut = int(np.searchsorted(w, w[-1])) if len(w) else 0  # the last symbol may go on
            if cut:
                yield from out([*held, part.slice(0, cut)])
                held = []
            held.append(part.slice(cut))
            if sum(p.nbytes for p in held) > 64 << 20:
                held = list(out(held))
        if held:
            yield from out(held)

    def merge(rows: DataFrame, *by: object) -> DataFrame:
        return rows.repartition("w", *by).sortWithinPartitions(*by, "w").select(*columns).mapInArrow(merged, PACKED)

    columns = [c.split()[0] for c in PACKED.split(", ")]
    is_hot = (F.col("w") <= hot) | (F.col("w") >= first)
    part = F.when(is_hot, F.spark_partition_id() % spread).otherwise(0)
    once = table(merge(texts.mapInArrow(counted, PACKED).withColumn("part", part), "part"), "pairs")
    return once.where(~is_hot).unionByName(table(merge(once.where(is_hot)), "hot"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(grid: np.ndarray) -> float:
    """What the log likelihood of the classes adds to that of the words."""
    return float(_xlogx(grid).sum() - _xlogx(grid.sum(1)).sum() - _xlogx(grid.sum(0)).sum())


def class_grids(neighbours: DataFrame, options: list[np.ndarray], groups: int) -> list[np.ndarray]:
    """Counts of class pairs for each of some tables of classes, in one pass; at most groups squared each reach the driver."""
    cells = groups * groups

    def summed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(options), cells), np.int64)
        for part in parts:
            bounds, other, n = _side(part, "after")
            first, last = int(bounds[0]), int(bounds[-1])
            words, times = part.column(0).to_numpy(), np.diff(bounds)
            for k, of in enumerate(options):
                total[k] += np.bincount(np.repeat(of[words] * groups, times) + of[other[first:last]], weights=n[first:last], minlength=cells).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], names=["at", "n"])

    grids = np.zeros(len(options) * cells)
    for r in neighbours.select("w", "after_at", "after_n").mapInArrow(summed, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        grids[r["at"]] = r["n"]
    return list(grids.reshape(len(options), groups, groups))


def class_grid(neighbours: DataFrame, of: np.ndarray, groups: int) -> np.ndarray:
    return class_grids(neighbours, [of], groups)[0]


class Exchange:
    """One task's view of the classes, moved word by word."""

    def __init__(self, of: np.ndarray, grid: np.ndarray, classes: int):
        self.of, self.grid = of.copy(), grid.copy()
        self.left, self.right = self.grid.sum(1), self.grid.sum(0)
        self.own = slice(1, classes + 1)

    def put(self, c: int, row: np.ndarray, col: np.ndarray, loop: float, sign: int) -> None:
        self.grid[c] += sign * row
        self.grid[:, c] += sign * col
        self.grid[c, c] += sign * loop
        self.left[c] += sign * (row.sum() + loop)
        self.right[c] += sign * (col.sum() + loop)

    def move(self, w: int, after: np.ndarray, after_n: np.ndarray, before: np.ndarray, before_n: np.ndarray) -> int:
        """The class where word ``w`` raises the likelihood most, given the words after and before it with their counts."""
        a, groups = int(self.of[w]), len(self.grid)
        loop = float(after_n[after == w].sum())
        row = np.bincount(self.of[after], weights=after_n, minlength=groups)
        col = np.bincount(self.of[before], weights=before_n, minlength=groups)
        row[a] -= loop
        col[a] -= loop
        self.put(a, row, col, loop, -1)
        own, grid = self.own, self.grid
        r, c = np.flatnonzero(row), np.flatnonzero(col)
        sub, back = grid[own][:, r], grid[:, own][c].T
        gain = (_xlogx(sub + row[r]) - _xlogx(sub)).sum(1) + (_xlogx(back + col[c]) - _xlogx(back)).sum(1)
        here = np.diagonal(grid)[own]  # the cell of a class with itself gets all three parts at once
        gain += _xlogx(here + row[own] + col[own] + loop) - _xlogx(here + row[own]) - _xlogx(here + col[own]) + _xlogx(here)
        left, right, outs, ins = self.left[own], self.right[own], row.sum() + loop, col.sum() + loop
        gain -= _xlogx(left + outs) - _xlogx(left) + _xlogx(right + ins) - _xlogx(right)
        best = 1 + int(np.argmax(gain))
        if gain[best - 1] <= gain[a - 1] + 1e-9:
            best = a
        self.put(best, row, col, loop, 1)
        self.of[w] = best
        return best


def sweep(neighbours: DataFrame, of: np.ndarray, grid: np.ndarray, classes: int, batches: int) -> np.ndarray:
    """``of`` after every batch (the words' ranks modulo ``batches``) has moved its words, a packed row each, by rank."""

    def moved(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        view, at = None, -1
        for part in parts:
            words, out = part.column(0).to_numpy(), []
            (i, a, n), (j, b, m) = _side(part, "after"), _side(part, "before")
            for k, w in enumerate(words):
                if view is None or w % batches != at:
                    view, at = Exchange(of, grid, classes), w % batches
                x, y = slice(i[k], i[k + 1]), slice(j[k], j[k + 1])
                out.append(view.move(int(w), a[x], n[x], b[y], m[y]))
            yield pa.RecordBatch.from_arrays([pa.array(words), pa.array(out, pa.int32())], names=["w", "c"])

    batch = F.col("w") % batches
    dealt = neighbours.coalesce(1) if batches == 1 else neighbours.repartition(min(batches, _tasks(neighbours)), batch)
    new = of.copy()
    for r in dealt.sortWithinPartitions(batch, "w").mapInArrow(moved, "w int, c int").collect():  # one small row for each clustered word
        new[r["w"]] = r["c"]
    return new


def _tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def exchange(neighbours: DataFrame, words: int, params: Params) -> tuple[np.ndarray, np.ndarray]:
    """(class of every symbol, grid of class pairs): end 0, words by exchange 1..classes, each shape its own.

    The most frequent words start with a class each, all others share the last one, so no two classes begin alike. The
    ``lead`` most frequent are moved as one batch first, so that all batches of ``batch`` words or so start from the same
    kinds of classes instead of each its own.
    """
    groups = params.classes + 1 + SHAPES
    of = np.concatenate([[0], np.minimum(np.arange(words), params.classes - 1) + 1, params.classes + 1 + np.arange(SHAPES)])
    grid = class_grid(neighbours, of, groups)
    if not words:
        return of, grid
    lead = table(neighbours.where(F.col("w").between(1, min(words, params.lead))), "lead", 1)
    for _ in range(2):
        of = sweep(lead, of, grid, params.classes, 1)
        grid = class_grid(neighbours, of, groups)
    own, batches = neighbours.where(F.col("w").between(1, words)), -(-words // params.batch)
    batch = np.arange(len(of)) % batches
    for k in range(params.sweeps):
        moved, before = sweep(own, of, grid, params.classes, batches), likelihood(grid)
        options = [np.where(batch % (1 << j) == k % (1 << j), moved, of) for j in range(batches.bit_length())]  # all batches' moves, every second one's...
        grids = class_grids(neighbours, options[:1], groups)
        if likelihood(grids[0]) <= before:
            grids += class_grids(neighbours, options[1:], groups) if options[1:] else []
        new = next((x for x in zip(options, grids) if likelihood(x[1]) > before), None)
        if new is None:
            break
        of, grid = new
        if likelihood(grid) - before < params.settled * abs(before):
            break
    return of, grid


def most_frequent(counts: DataFrame, most: int) -> list[tuple[str, int]]:
    """(word, count) by falling count: all words of at least a frequency that no more than ``most`` have.

    The frequency comes from counts by sixteenths of powers of two, so only the words asked for are sent.
    """
    step = F.floor(F.log2("c") * 16)
    sizes = sorted(((r["s"], r["n"]) for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("n")).collect()), reverse=True)
    total, least = 0, None
    for s, n in sizes:
        total += n
        if total > most:
            break
        least = s
    rows = counts.where(step >= least).collect() if least is not None else []
    return sorted(((r["word"], r["c"]) for r in rows), key=lambda x: (-x[1], x[0]))


def train(texts: DataFrame, text_col: str = "text", params: Params = Params()) -> Model:
    """Learn from every row of ``texts``; null texts count as empty ones, that is, as an end."""
    small_batches(texts.sparkSession)
    rows = texts.select(F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    counts = table(word_counts(rows), "counts")
    top = most_frequent(counts, params.known)
    clustered = [(w, c) for w, c in top if c >= params.least]
    symbol = {w: i + 1 for i, (w, _) in enumerate(clustered)}
    class_of, grid = exchange(neighbour_counts(rows, symbol), len(clustered), params)
    shapes = counts.groupBy(shape_column(F.col("word")).alias("s")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    ends, first, groups = int(grid[:, 0].sum()), params.classes + 1, len(grid)
    n, v = np.zeros(groups), np.zeros(groups)
    n[0], v[0] = ends, 1
    for r in shapes:
        n[first + r["s"]], v[first + r["s"]] = r["n"], r["v"]
    for i, (w, c) in enumerate(clustered):
        of = first + shape(w.encode())
        n[of], v[of] = n[of] - c, v[of] - 1
        n[class_of[i + 1]] += c
        v[class_of[i + 1]] += 1
    transition = np.log10((grid + params.alpha) / (grid.sum(1, keepdims=True) + params.alpha * groups))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    classes = {w: int(class_of[i + 1]) for i, (w, _) in enumerate(clustered)}
    return Model(counts, dict(top), classes, first, transition, -np.log10(n + v + 1), int(total[0]) + ends, int(total[1]) + (ends > 0), ends)


def score(texts: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, n_known, base_score, score): one row for each row of ``texts``.

    ``score`` is the model's log10 probability of the text with its end; ``base_score`` that of an
    add-one unigram. Null texts count as empty, texts of any length are scored whole in one row's memory; rows
    that repeat an id, or have none, are each scored. Words of equal counts are ranked by code point, so ties
    change nothing between runs. Columns other than the two named aren't read.
    """
    small_batches(texts.sparkSession)
    classes, first, known, transition, emission = model.classes, model.shapes, model.known, model.transition, model.emission
    names = ["row", "id", "word", "n", "k", "chain", "logs"]

    def scored(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, vocabulary = len(known), [*known, *(w for w in classes if w not in known)]
        of = Numbers({w: k for k, w in enumerate(vocabulary)}, len(vocabulary))  # a word's place, or beyond all places its shape
        to = np.array([*(classes[w] if w in classes else first + shape(w.encode()) for w in vocabulary), *range(first, first + SHAPES)], np.int64)
        logs = np.zeros(len(to))
        logs[:size] = [math.log10(c + 1) for c in known.values()]
        for part in parts:
            whole: list[tuple] = []
            at_row, new_words, times = [], [], []
            for row, text in zip(part.column(0).to_pylist(), part.column(2).to_pylist()):
                words = _words(text)
                at = np.fromiter(map(of.__getitem__, words), np.int64, len(words))
                c = np.concatenate([[0], to[at], [0]])
                new = np.flatnonzero(at >= size).tolist()
                chain = float(transition[c[:-1], c[1:]].sum() + emission[c[1:]].sum())
                whole.append((row, len(words) + 1, len(words) - len(new), chain, float(logs[at].sum())))
                rest = Counter([words[k] for k in new])
                at_row += [row] * len(rest)
                new_words += rest
                times += rest.values()
            n = len(new_words)
            zeros = lambda kind: pa.array(np.zeros(n, kind))  # noqa: B023, E731
            joined = lambda first, second, kind: pa.concat_arrays([pa.array(first, kind), second.cast(kind)])
            row, tokens, k, chain, known_logs = zip(*whole) if whole else ((),) * 5
            columns = [
                joined(row, pa.array(at_row, pa.int64()), pa.int64()), pa.concat_arrays([part.column(1), pa.nulls(n, pa.int64())]), pa.concat_arrays([pa.nulls(len(row), pa.string()), pa.array(new_words, pa.binary()).cast(pa.string())]),
                joined(tokens, pa.array(times, pa.int64()), pa.int64()), joined(k, zeros(np.int64), pa.int64()), joined(chain, zeros(np.float64), pa.float64()), joined(known_logs, zeros(np.float64), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = texts.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    parts = table(rows.mapInArrow(scored, "row long, id long, word string, n long, k long, chain double, logs double"), "scored")
    end = int(model.ends > 0)
    whole = parts.where("word is null").select("row", "id", F.col("n").alias("n_tokens"), (F.col("k") + end).alias("n_known"), "chain", (F.col("logs") + math.log10(model.ends + 1)).alias("logs"))
    c = F.coalesce("c", F.lit(0))
    rest = parts.where("word is not null").join(model.counts.withColumnRenamed("word", "w"), F.col("word") == F.col("w"), "left").select(
        "row", F.lit(None).cast("long").alias("id"), F.lit(0).cast("long").alias("n_tokens"), F.when(c > 0, F.col("n")).otherwise(0).alias("n_known"),
        F.lit(0.0).alias("chain"), (F.col("n") * F.log10(c + 1)).alias("logs"),
    )
    summed = whole.unionByName(rest).groupBy("row").agg(
        F.max("id").alias(id_col), *[F.sum(x).alias(x) for x in ("n_tokens", "n_known", "chain", "logs")]
    )
    return summed.select(
        id_col, "n_tokens", "n_known",
        (F.col("logs") - F.col("n_tokens") * F.lit(math.log10(model.tokens + model.types + 1))).alias("base_score"),
        (F.col("chain") + F.col("logs")).alias("score"),
    )
