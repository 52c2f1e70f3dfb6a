"""Document scores by masked pseudo-likelihood of a bidirectional window network over tokens."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pitsync.llm.packing import ADDED, tokenizer, vocabulary
from pitsync.llm.staging import stage

#: Places around a hidden token that the network sees.
STEPS = (-2, -1, 1, 2)
#: Tokens scored at once, so that a long text needs no more memory than a short one.
CHUNK = 4096
#: Nodes nearest the root whose scores come from products of matrices.
CROWN = 32
#: Bytes of ids that leave a task at once, or those of one longer text.
ENCODED = 4_000_000
#: Tokens of whole texts that a task works on at once, or those of one longer text.
TOKENS = 500_000


@dataclass(frozen=True)
class Crown:
    """The heaviest nodes of a tree, which are above all others, so most steps of most paths.

    A token leaves the crown by door ``door[t]`` after ``below[t]`` steps from its own end.
    ``sides[d]`` says on which side of each node of the crown the door lies, 0 for nodes that
    are not on its path.
    """

    door: np.ndarray
    below: np.ndarray
    sides: np.ndarray


@dataclass(frozen=True)
class Tree:
    """A Huffman tree over the vocabulary: its inner nodes from each token up to the root.

    The path of token t is ``nodes[first[t]:first[t + 1]]``; ``signs`` says on which side
    of each node the token lies. Nodes are numbered by their weight, the root last.
    """

    first: np.ndarray
    nodes: np.ndarray
    signs: np.ndarray

    @cached_property
    def crown(self) -> Crown:
        size = len(self.first) - 1
        bound = max(0, size - 1 - CROWN)
        below = np.add.reduceat(self.nodes < bound, self.first[:-1], dtype=np.int16)
        last = self.nodes[self.first[:-1] + np.maximum(below, 1) - 1]
        _, some, door = np.unique(np.where(below > 0, last, size + np.arange(size)), return_index=True, return_inverse=True)
        sides = np.zeros((len(some), size - 1 - bound), dtype=np.float32)
        for d, token in enumerate(some):
            path = slice(self.first[token] + below[token], self.first[token + 1])
            sides[d, self.nodes[path] - bound] = self.signs[path]
        return Crown(door.astype(np.int32), below, sides)


@dataclass(frozen=True)
class WindowModel:
    """The tree and all weights in one matrix.

    Rows: an embedding per token and one for what is beyond a text's ends, a vector and a
    bias (last column) per inner node, a scale per place, the bias of the hidden layer.
    """

    tree: Tree
    weights: np.ndarray


def huffman(counts: np.ndarray) -> tuple[Tree, np.ndarray]:
    """The tree of these counts, and the bias of each node that gives every token its share."""
    size = len(counts)
    mass = np.zeros(2 * size - 1)
    mass[:size] = counts + 0.5  # tokens that no text holds have a probability, too
    parent, sign = np.full(2 * size - 1, -1), np.zeros(2 * size - 1, dtype=np.int8)
    bias = np.zeros(size - 1)
    heap = [(m, i) for i, m in enumerate(mass[:size].tolist())]
    heapify(heap)
    for new in range(size, 2 * size - 1):
        (a, left), (b, right) = heappop(heap), heappop(heap)
        parent[left] = parent[right] = new
        sign[left], sign[right] = -1, 1
        mass[new], bias[new - size] = a + b, np.log(b / a)
        heappush(heap, (a + b, new))
    tokens, at, found = np.arange(size), np.arange(size), []
    while len(tokens):
        found.append((tokens, parent[at] - size, sign[at]))
        at = parent[at]
        inner = parent[at] >= 0
        tokens, at = tokens[inner], at[inner]
    owner = np.concatenate([f[0] for f in found])
    order = np.argsort(owner, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=size))])
    nodes, signs = (np.concatenate([f[k] for f in found])[order] for k in (1, 2))
    return Tree(first, nodes.astype(np.int32), signs.astype(np.float32)), bias


def _start(counts: np.ndarray, hidden: int, seed: int) -> WindowModel:
    """The untrained model: every token has its share of the corpus in any context."""
    tree, bias = huffman(counts)
    size = len(counts)
    weights = np.zeros((2 * size + len(STEPS) + 1, hidden + 1), dtype=np.float32)
    weights[: size + 1, :hidden] = np.random.default_rng(seed).normal(0, 0.3, (size + 1, hidden))
    weights[size + 1 : 2 * size, hidden] = bias
    weights[2 * size : 2 * size + len(STEPS), :hidden] = 1
    return WindowModel(tree, weights)


def padded(ids: np.ndarray, lengths: np.ndarray, edge: int) -> tuple[np.ndarray, np.ndarray]:
    """These texts with ``edge`` on both sides of each, and where their tokens are now."""
    reach = max(STEPS)
    room = np.full(len(ids) + reach * (len(lengths) + 1), edge, dtype=np.int32)
    at = np.arange(len(ids)) + reach * (np.repeat(np.arange(len(lengths)), lengths) + 1)
    room[at] = ids
    return room, at


def windows(room: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The tokens at the places around each of these tokens, one row each."""
    return room.take(at[:, None] + STEPS)


def _hidden(model: WindowModel, around: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hidden layer, with a 1 for the bias and zeros up to an even width; the embeddings it is
    from, side by side; and per place the matrix that takes the ones to the other."""
    w, size = model.weights, len(model.tree.first) - 1
    columns = w.shape[1]
    seen = w.take(around.ravel(), axis=0).reshape(len(around), -1)
    even = np.eye(columns, columns + columns % 2, dtype=w.dtype)
    scales = w[2 * size : -1, :, None] * even
    h = seen @ scales.reshape(-1, scales.shape[2])
    h += w[-1] @ even
    np.tanh(h, out=h)
    h[:, columns - 1] = 1
    return h, seen, scales


def _scaled(model: WindowModel) -> list[np.ndarray]:
    """The embeddings, times the scale of each place."""
    size = len(model.tree.first) - 1
    return [model.weights[: size + 1] * scale for scale in model.weights[2 * size : -1]]


def token_scores(model: WindowModel, ids: np.ndarray, around: np.ndarray, scaled: list[np.ndarray] | None = None) -> np.ndarray:
    """log P(token | tokens on both sides) of every token.

    No sum runs over more than one token, and so none is rounded by what is scored with it.
    """
    w, tree = model.weights, model.tree
    h = np.repeat(w[-1:], len(ids), axis=0)
    for place, embedded in enumerate(scaled or _scaled(model)):
        h += embedded.take(around[:, place], axis=0)
    np.tanh(h, out=h)
    h[:, -1] = 1
    begin = tree.first.take(ids)
    steps = tree.first.take(ids + 1) - begin
    ends = np.cumsum(steps)
    at = np.repeat(begin - ends + steps, steps)
    at += np.arange(len(at))
    at_nodes = w.take(tree.nodes.take(at) + np.int32(len(tree.first)), axis=0)
    z = np.einsum("nd,nd->n", at_nodes, np.repeat(h, steps, axis=0))
    z *= tree.signs.take(at)
    low = np.minimum(z, 0)
    low -= np.log(1 + np.exp(-np.abs(z)))
    return np.add.reduceat(low, ends - steps)


def text_scores(model: WindowModel, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The sum over the tokens of each text."""
    room, at = padded(ids, lengths, len(model.tree.first) - 1)
    scaled = _scaled(model)
    each = [token_scores(model, room[x], windows(room, x), scaled) for x in (at[i : i + CHUNK] for i in range(0, len(at), CHUNK))]
    sums = np.concatenate([[0.0], *each]).cumsum(dtype=np.float64)
    ends = np.cumsum(lengths)
    return sums[ends] - sums[ends - lengths]


def _by_row(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The order that sorts these rows, the different ones, and where each begins."""
    # a vocabulary of less than 65,536 has 16-bit numbers, which numpy sorts by radix
    order = np.argsort(rows.astype(np.min_scalar_type(rows.max())), kind="stable")
    rows = rows.take(order)
    changed = np.ones(len(rows), dtype=bool)
    np.not_equal(rows[1:], rows[:-1], out=changed[1:])
    begin = np.flatnonzero(changed)
    return order, rows.take(begin), begin


def _sums(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of the rows from each of these on; two columns at a time, as complex numbers."""
    return np.add.reduceat(values.view(np.result_type(values, np.complex64)), begin, axis=0).view(values.dtype)


def _pull(z: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """The slope of log(1 / (1 + exp(-z))) along the score without its sign."""
    np.minimum(z, 60, out=z)
    np.exp(z, out=z)
    z += 1
    return np.divide(signs, z, out=z)


def gradient(model: WindowModel, ids: np.ndarray, around: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of the weights and the slope of the summed log probability along them."""
    w, tree, crown = model.weights, model.tree, model.tree.crown
    size, top = len(tree.first) - 1, len(crown.sides[0])
    # windows with longer paths below the crown come first, so that those of any step are the first ones
    steps = crown.below.take(ids)
    order = np.argsort(-steps, kind="stable")
    ids, around, steps = ids.take(order), around.take(order, axis=0), steps.take(order)
    wide, seen, scales = _hidden(model, around)
    columns = w.shape[1]
    h = wide[:, :columns]

    door = crown.door.take(ids)
    sides, nodes = crown.sides.take(door, axis=0), w[2 * size - top : 2 * size]
    z = h @ nodes.T
    z *= sides
    g = _pull(z, sides)
    slope = g @ nodes
    used = np.flatnonzero(np.bincount(door, minlength=len(crown.sides)) @ np.abs(crown.sides))
    found = [(used + (2 * size - top), (g.T @ h).take(used, axis=0))]

    if steps[0]:
        long = len(ids) - np.bincount(steps)[:-1].cumsum()
        ends = np.cumsum(long)
        owner = np.arange(ends[-1]) - np.repeat(ends - long, long)
        at = tree.first.take(ids).take(owner) + np.repeat(np.arange(steps[0]), long)
        nodes, signs = tree.nodes.take(at), tree.signs.take(at)
        at_nodes = w.take(nodes + np.int32(size + 1), axis=0)
        g = _pull(signs * np.einsum("nd,nd->n", at_nodes, wide.take(owner, axis=0)[:, :columns]), signs)[:, None]
        at_nodes *= g
        for n, end in zip(long.tolist(), ends.tolist()):
            slope[:n] += at_nodes[end - n : end]
        # values are gathered in the order of their rows, and multiplied where they lie
        order, node_rows, begin = _by_row(nodes)
        of_node = wide.take(owner.take(order), axis=0)
        of_node *= g.take(order, axis=0)
        found.append((node_rows + (size + 1), _sums(of_node, begin)[:, :columns]))

    slope *= (1 - wide * wide)[:, :columns]  # 0 in the column of the bias
    of_places = np.einsum("nk,npk->pk", slope, seen.reshape(len(ids), len(STEPS), columns))
    flat = np.vstack([of_places, np.ones(len(ids), slope.dtype) @ slope])
    found.append((np.arange(2 * size, 2 * size + len(STEPS) + 1), flat))
    order, token_rows, begin = _by_row(around.ravel())
    of_token = (slope @ scales.transpose(1, 0, 2).reshape(columns, -1)).reshape(around.size, -1)
    found.append((token_rows, _sums(of_token.take(order, axis=0), begin)[:, :columns]))
    return found


def climb(model: WindowModel, touched: np.ndarray, squares: np.ndarray, ids: np.ndarray, around: np.ndarray, rate: float) -> None:
    """One step up the gradient (AdaGrad), in place."""
    found = gradient(model, ids, around)
    rows, slope = (np.concatenate([f[k] for f in found]) for k in (0, 1))  # no row is in two of them
    seen = slope * slope
    seen += squares.take(rows, axis=0)
    squares[rows] = seen
    slope *= rate
    slope /= np.sqrt(seen, out=seen)
    slope += model.weights.take(rows, axis=0)
    model.weights[rows] = slope
    touched[rows] += 1


def _lengths(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("ids")
    if pa.types.is_list(column.type):
        return column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64) // 4


def _lists(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All ids, from arrays or packed, and how many each text has."""
    column = batch.column("ids")
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False), _lengths(batch)
    return np.frombuffer(b"".join(column.to_pylist()), np.int32), _lengths(batch)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in runs of whole texts of at most ``TOKENS`` tokens, or one longer text."""
    for batch in batches:
        ends = np.cumsum(_lengths(batch))
        begin = 0
        while begin < len(ends):
            before = ends[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(ends, before + TOKENS, side="right")))
            yield batch.slice(begin, stop - begin)
            begin = stop


def _encode(path: str, doc_id: pa.DataType, packed: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(path)

        def rows(keys: list, ids: list[bytes]) -> pa.RecordBatch:
            column = pa.array(ids, pa.binary())
            if not packed:
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), np.int32), pa.int32())
                column = pa.ListArray.from_arrays(pa.array(offsets), flat)
            return pa.RecordBatch.from_pydict({"doc_id": pa.array(keys, doc_id), "ids": column})

        for batch in batches:
            keys, ids, held = [], [], 0
            for key, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                keys.append(key.as_py())
                ids.append(encode(text.as_py() or ""))
                held += len(ids[-1])
                if held > ENCODED:
                    yield rows(keys, ids)
                    keys, ids, held = [], [], 0
            yield rows(keys, ids)

    return run


def _token_counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in _pieces(batches):
            total += np.bincount(_lists(batch)[0], minlength=size)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"token": pa.array(seen, pa.int32()), "n": pa.array(total[seen], pa.int64())})

    return run


def _rows(rows: np.ndarray, n: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    flat = pa.array(np.ascontiguousarray(values, dtype=np.float32).ravel(), pa.float32())
    offsets = pa.array(np.arange(len(rows) + 1) * values.shape[1], pa.int32())
    return pa.RecordBatch.from_pydict({"row": pa.array(rows, pa.int32()), "n": pa.array(n, pa.float64()), "v": pa.ListArray.from_arrays(offsets, flat)})


def _train(sent, part: int, parts: int, rate: float, batch_size: int):
    """Train from the sent weights on a task's texts; yields the rows that moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = WindowModel(sent.value.tree, sent.value.weights.copy())
        size = len(model.tree.first) - 1
        touched, squares = np.zeros(len(model.weights)), np.full(model.weights.shape, 0.1, dtype=np.float32)
        rng = np.random.default_rng(part)
        for batch in _pieces(batches):
            ids, lengths = _lists(batch)
            ends = np.cumsum(lengths)
            # every text starts elsewhere, so that short ones take part as often as long ones
            place = np.arange(len(ids)) - np.repeat(ends - lengths, lengths) + np.repeat(lengths, lengths)
            chosen = rng.permutation(np.flatnonzero(place % parts == part))
            if not len(chosen):
                continue
            room, at = padded(ids, lengths, size)
            for i in range(0, len(chosen), batch_size):
                some = at[chosen[i : i + batch_size]]
                climb(model, touched, squares, room[some], windows(room, some), rate)
        moved = np.flatnonzero(touched)
        yield _rows(moved, touched[moved], model.weights[moved])

    return run


def _mean(columns: int):
    """Sums rows of weights as they stream by; a task holds one row per row number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, columns).astype(np.float64)
            n = batch.column("n").to_numpy(zero_copy_only=False)
            for row, weight, value in zip(batch.column("row").to_pylist(), n, values, strict=True):
                own = sums.setdefault(row, [0.0, np.zeros(columns)])
                own[0] += weight
                own[1] += weight * value
        rows = np.array(sorted(sums), dtype=np.int32)
        n = np.array([sums[r][0] for r in rows])
        values = np.array([sums[r][1] / sums[r][0] for r in rows]).reshape(-1, columns)
        yield _rows(rows, n, values)

    return run


def encoded(docs: DataFrame, path: str | None = None, packed: bool = False) -> DataFrame:
    """(doc_id, ids), written: the tokens of each whole text, none for a null or empty one.

    ``packed`` ids are 32-bit numbers in bytes, which Spark moves whole and not one by one.
    """
    kind = docs.schema["doc_id"].dataType
    run = _encode(path or vocabulary(), to_arrow_type(kind), packed)
    ids = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind.simpleString()}, ids {'binary' if packed else 'array<int>'}")
    return stage(ids, "tokens")


def vocabulary_size(path: str | None = None) -> int:
    with open(path or vocabulary(), "rb") as lines:
        return max(max(int(line.split()[1]) for line in lines), *ADDED.values()) + 1


def fit(
    tokens: DataFrame,
    size: int | None = None,
    hidden: int = 16,
    every: int = 2,
    rounds: int = 2,
    rate: float = 0.3,
    batch_size: int = 1024,
    seed: int = 7,
) -> WindowModel:
    """Count the tokens of all texts, then train the network on all of their windows.

    A round takes one window of ``every`` consecutive ones, another in each round, from
    every text; ``every`` rounds take each window of the corpus once. Each task trains from the
    weights of the round before; then a weight becomes the mean over the tasks that moved
    it, by how often they did, which Spark shuffles by row of the weights. The driver gets
    one row of ``hidden + 1`` numbers per token and per node at most, as the vocabulary is
    fixed.
    """
    if every < 1 or rounds < 1 or rounds % every:
        raise ValueError("rounds must take every window, and each as often as any other")
    spark, size = tokens.sparkSession, size or vocabulary_size()
    ids = tokens.select("ids")
    summed = ids.mapInArrow(_token_counts(size), "token int, n long").groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size, dtype=np.int64)
    counts[summed.column("token").to_numpy()] = summed.column("n").to_numpy()
    model = _start(counts, hidden, seed)
    for part in range(rounds):
        sent = spark.sparkContext.broadcast(model)
        kind = "row int, n double, v array<float>"
        moved = ids.mapInArrow(_train(sent, part % every, every, rate / (1 + part), batch_size), kind)
        rows = moved.repartition("row").mapInArrow(_mean(hidden + 1), kind).toArrow().combine_chunks()
        at = rows.column("row").to_numpy()
        weights = model.weights.copy()
        if len(at):
            weights[at] = rows.column("v").combine_chunks().flatten().to_numpy().reshape(-1, hidden + 1)
        model = WindowModel(model.tree, weights)
    return model


def score_corpus(docs: DataFrame, model: WindowModel | None = None, path: str | None = None, **options: object) -> DataFrame:
    """One row per document: doc_id, n_tokens, log_likelihood, mean_log_likelihood.

    Each token of the public vocabulary at ``path`` is hidden in turn and predicted by a
    network from two tokens on either side; the sum of the log probabilities is the
    pseudo-likelihood of the whole text. The network's output is a probability of each
    token, as a product over the nodes of a Huffman tree. ``options`` go to ``fit``.

    A null or empty text has no tokens, 0 in all and a null mean. Rows are independent:
    repeated ones get equal scores. An empty table gives an empty result; other columns
    are not looked at.
    """
    tokens = encoded(docs, path, packed=True)
    model = model or fit(tokens, vocabulary_size(path), **options)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            ids, lengths = _lists(batch)
            sums = text_scores(sent.value, ids, lengths)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "n_tokens": pa.array(lengths), "log_likelihood": pa.array(sums)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = tokens.mapInArrow(score, f"doc_id {kind}, n_tokens long, log_likelihood double")
    mean = F.when(F.col("n_tokens") > 0, F.col("log_likelihood") / F.col("n_tokens"))
    return out.select("*", mean.alias("mean_log_likelihood"))
