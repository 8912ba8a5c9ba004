"""Hidden Markov language model: Baum-Welch counts summed across partitions, exact scaled forward scores.

Tokens are lower-cased words and one end per text.  The latent states emit
``BUCKETS`` hash buckets of words (a table of fixed size, whatever the
corpus), and a bucket emits its words by their training counts, with half a
count for each word and for one unknown word:

    p(token | state) = E[state, bucket] * (c + 0.5) / (C_bucket + 0.5 * (V_bucket + 1))

so the model is a proper distribution over all texts.  The corpus is encoded
once into blocks (token numbers of a block-local vocabulary), written to the
shared folder; each Baum-Welch round reads all training texts of all blocks
and adds up expected counts by bucket.  Exact word counts reach a block by a
join on its own vocabulary: nothing that grows with the corpus is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from clickpath.llm.hashing import utf8_chunks, word_hashes
from clickpath.llm.storage import materialize

STATES = 8
BUCKETS = 1 << 15
ROUNDS = 5
STAY = 0.98
SEED = 20240229
BLOCK_BYTES = 8 << 20
BLOCKS_PER_TASK = 6
END = np.uint64(0x5EED0F7E97E2D00D)
TRANSITION_ROW = -1
START_ROW = -2
GROUP_TOKENS = 1 << 19

_BLOCKS = ("block long, doc_id array<long>, held_out array<boolean>, lengths array<int>, vocab array<long>, "
           "train array<long>, tokens binary")


@dataclass(frozen=True)
class Model:
    """start (K), move (K, K), emit (K, BUCKETS): probabilities."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def held_out_of(doc_id: Column) -> Column:
    """True for the fifth of the ids that is not learnt from (a null id counts as an empty text)."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 5 == 1


def token_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes with the end of each text, tokens of each text)."""
    parts, lengths = [], []
    for _, data, offsets in utf8_chunks(texts):
        words, bounds = word_hashes(data, offsets)
        parts.append(np.insert(words, bounds[1:], END))
        lengths.append(np.diff(bounds) + 1)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(parts), np.concatenate(lengths)


def pack_numbers(numbers: np.ndarray) -> bytes:
    """uint32 numbers by byte planes, which the codecs of files and shuffles shrink well."""
    return np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack_numbers(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).reshape(-1).view("<u4")


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32
    for batch in batches:
        sizes = np.cumsum(np.array([len(s) if s is not None else 0 for s in batch.column("text").cast(pa.binary()).to_pylist()], np.int64))
        row = 0
        while row < batch.num_rows:
            done = sizes[row - 1] if row else 0
            last = max(row + 1, int(np.searchsorted(sizes, done + BLOCK_BYTES, "right")))
            part = batch.slice(row, last - row)
            row = last
            tokens, lengths = token_hashes(part.column("text"))
            vocab, local, count = np.unique(tokens, return_inverse=True, return_counts=True)
            # frequent words get small numbers, so most high bytes of the token numbers are zero
            by_count = np.argsort(-count, kind="stable")
            rank = np.empty(len(vocab), np.int64)
            rank[by_count] = np.arange(len(vocab))
            vocab, local = vocab[by_count], rank[local]
            held = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
            train = np.bincount(local, np.repeat(~held, lengths), minlength=len(vocab)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                pa.array([held.tolist()], pa.list_(pa.bool_())), pa.array([lengths.tolist()], pa.list_(pa.int32())),
                pa.array([vocab.view(np.int64)], pa.list_(pa.int64())), pa.array([train], pa.list_(pa.int64())),
                pa.array([pack_numbers(local)], pa.binary())],
                ["block", "doc_id", "held_out", "lengths", "vocab", "train", "tokens"])
            block += 1


def encode(docs: DataFrame) -> DataFrame:
    """Blocks of encoded texts, about ``BLOCK_BYTES`` of text each."""
    doc_id = F.col("doc_id").cast("long")
    return materialize(
        docs.select(doc_id.alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), held_out_of(doc_id).alias("held_out"))
        .mapInArrow(_encode, _BLOCKS), "lm-blocks")


def word_counts(blocks: DataFrame) -> DataFrame:
    """(word, bucket, c): the training count of every token of the corpus, 0 for those only held out."""
    return materialize(
        blocks.select(F.explode(F.arrays_zip("vocab", "train")).alias("e"))
        .groupBy(F.col("e.vocab").alias("word")).agg(F.sum("e.train").alias("c"))
        .withColumn("bucket", F.col("word").bitwiseAND(F.lit(BUCKETS - 1)).cast("int")), "lm-counts")


@dataclass(frozen=True)
class Packed:
    """Texts in time-major order: step t holds the first ``active[t]`` texts, longest first."""

    order: np.ndarray
    active: np.ndarray
    at: np.ndarray
    offset: np.ndarray


def pack(lengths: np.ndarray, starts: np.ndarray) -> Packed:
    order = np.argsort(-lengths, kind="stable")
    ordered = lengths[order]
    active = np.searchsorted(-ordered, -np.arange(1, ordered[0] + 1), "right")
    offset = np.concatenate([[0], np.cumsum(active)])
    step = np.repeat(np.arange(len(active)), active)
    who = np.arange(offset[-1]) - np.repeat(offset[:-1], active)
    return Packed(order, active, starts[order][who] + step, offset)


def text_groups(lengths: np.ndarray, most: int = GROUP_TOKENS) -> Iterator[np.ndarray]:
    """Texts of like length, at most about ``most`` tokens together."""
    order = np.argsort(-lengths, kind="stable")
    cut = np.cumsum(lengths[order]) // most
    for part in np.split(order, np.flatnonzero(np.diff(cut)) + 1):
        if len(part):
            yield part


def forward(model: Model, emitted: np.ndarray, packed: Packed, keep: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Scaled forward recursion: (scale of every packed token, forward rows if ``keep``).

    The product of a text's scales is its exact likelihood.
    """
    scale = np.empty(packed.offset[-1])
    rows = np.empty_like(emitted) if keep else None
    now = None
    for t, n in enumerate(packed.active):
        lo, hi = packed.offset[t], packed.offset[t] + n
        now = (model.start if t == 0 else now[:n] @ model.move) * emitted[lo:hi]
        total = now.sum(axis=1)
        now /= total[:, None]
        scale[lo:hi] = total
        if keep:
            rows[lo:hi] = now
    return scale, rows


def expected_counts(model: Model, buckets: np.ndarray, packed: Packed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch E step of one group: expected (start, move, state rows of every packed token)."""
    emitted = model.emit.T[buckets]
    scale, alpha = forward(model, emitted, packed, keep=True)
    emitted /= scale[:, None].astype(emitted.dtype)
    beta = np.ones_like(alpha)
    back = model.move.T.copy()
    for t in range(len(packed.active) - 2, -1, -1):
        n = packed.active[t + 1]
        lo, nxt = packed.offset[t], packed.offset[t + 1]
        beta[lo:lo + n] = (emitted[nxt:nxt + n] * beta[nxt:nxt + n]) @ back
    first = packed.active[0]
    later = np.arange(first, packed.offset[-1])
    step = np.repeat(np.arange(1, len(packed.active)), packed.active[1:])
    earlier = later - packed.active[step - 1]
    move = model.move * (alpha[earlier].T @ (emitted[first:] * beta[first:]))
    gamma = alpha * beta
    return gamma[:first].sum(axis=0), move, gamma


def _expectations(model: Model):
    states = len(model.start)
    small = Model(*(x.astype(np.float32) for x in (model.start, model.move, model.emit)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit = np.zeros((states, BUCKETS))
        move, start, seen = np.zeros((states, states)), np.zeros(states), False
        for batch in batches:
            for b in range(batch.num_rows):
                lengths = np.array(batch.column("lengths")[b].values)
                train = ~np.array(batch.column("held_out")[b].values.to_numpy(zero_copy_only=False), bool)
                begins = np.cumsum(lengths) - lengths
                lengths, begins = lengths[train], begins[train]
                if not len(lengths):
                    continue
                vocab = batch.column("vocab")[b].values.to_numpy()
                bucket = (vocab & (BUCKETS - 1))[unpack_numbers(batch.column("tokens")[b].as_py())]
                seen = True
                for part in text_groups(lengths):
                    packed = pack(lengths[part], begins[part])
                    mine = bucket[packed.at]
                    s, m, gamma = expected_counts(small, mine, packed)
                    start += s
                    move += m
                    for k in range(states):
                        emit[k] += np.bincount(mine, gamma[:, k], BUCKETS)
        if seen:
            at = np.flatnonzero(emit.sum(axis=0))
            key = np.concatenate([at, np.arange(TRANSITION_ROW - 1, TRANSITION_ROW - 1 - states, -1), [TRANSITION_ROW]])
            rows = np.concatenate([emit[:, at].T, move, start[None, :]]).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32))] + [pa.array(rows[:, k].copy()) for k in range(states)],
                                             ["key"] + [f"k{k}" for k in range(states)])

    return run


def initial_model(bucket_share: np.ndarray, states: int = STATES, seed: int = SEED) -> Model:
    """States that tend to stay, with seeded random tilts of the corpus-wide bucket shares."""
    rng = np.random.Generator(np.random.PCG64(seed))
    emit = bucket_share * np.exp(rng.normal(size=(states, len(bucket_share))))
    move = np.full((states, states), (1 - STAY) / max(1, states - 1))
    np.fill_diagonal(move, STAY if states > 1 else 1.0)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(axis=1, keepdims=True))


def baum_welch_round(blocks: DataFrame, model: Model, bucket_share: np.ndarray) -> Model:
    """One round over all training texts; expected counts are summed by Spark, K x (BUCKETS + K + 1) numbers come back."""
    states = len(model.start)
    columns = [f"k{k}" for k in range(states)]
    counts = (blocks.select("held_out", "lengths", "vocab", "tokens")
              .mapInArrow(_expectations(model), ", ".join(["key int"] + [f"{c} float" for c in columns]))
              .groupBy("key").agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in columns]).toPandas())
    emit = np.zeros((states, len(bucket_share)))
    move, start = np.zeros((states, states)), np.zeros(states)
    values = counts[columns].to_numpy()
    for key, row in zip(counts["key"].tolist(), values):
        if key >= 0:
            emit[:, key] = row
        elif key == TRANSITION_ROW:
            start = row
        else:
            move[TRANSITION_ROW - 1 - key] = row
    # one pseudo-count in all keeps every probability above zero
    emit = emit + bucket_share
    move = move + 1.0 / states
    start = start + 1.0 / states
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


def train(blocks: DataFrame, counts: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> tuple[Model, np.ndarray, np.ndarray]:
    """(model, training tokens by bucket, training words by bucket)."""
    per_bucket = counts.groupBy("bucket").agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).toPandas()
    tokens, words = np.zeros(BUCKETS), np.zeros(BUCKETS)
    tokens[per_bucket["bucket"]] = per_bucket["n"]
    words[per_bucket["bucket"]] = per_bucket["v"]
    share = (tokens + 0.5) / (tokens + 0.5).sum()
    model = initial_model(share, states)
    # a task adds up several blocks before it sends its bucket counts
    grouped = blocks.coalesce(max(1, -(-blocks.count() // BLOCKS_PER_TASK)))
    for _ in range(rounds):
        model = baum_welch_round(grouped, model, share)
    return model, tokens, words


def _scorer(model: Model, tokens: np.ndarray, words: np.ndarray):
    total, distinct = float(tokens.sum()), float(words.sum())

    def score_block(block: pa.Table, local: pa.Table) -> pa.Table:
        vocab = np.array(block.column("vocab")[0].values)
        c = np.zeros(len(vocab))
        c[local.column("i").to_numpy()] = local.column("c").to_numpy()
        bucket_of = vocab & (BUCKETS - 1)
        base = np.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
        inside = np.log10((c + 0.5) / (tokens[bucket_of] + 0.5 * (words[bucket_of] + 1)))
        lengths = np.array(block.column("lengths")[0].values).astype(np.int64)
        begins = np.cumsum(lengths) - lengths
        local_id = unpack_numbers(block.column("tokens")[0].as_py())
        by_text = lambda x: np.add.reduceat(x[local_id], begins)
        score = by_text(inside)
        bucket = bucket_of[local_id]
        for part in text_groups(lengths):
            packed = pack(lengths[part], begins[part])
            scale, _ = forward(model, model.emit.T[bucket[packed.at]], packed, keep=False)
            who = np.arange(packed.offset[-1]) - np.repeat(packed.offset[:-1], packed.active)
            score[part[packed.order]] += np.bincount(who, np.log10(scale), len(part))
        n = len(lengths)
        return pa.Table.from_arrays([
            block.column("doc_id")[0].values, block.column("held_out")[0].values, pa.array(lengths),
            pa.array(by_text((c > 0).astype(np.int64))), pa.array(np.full(n, int(total))), pa.array(by_text(base)), pa.array(score)],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return score_block


def score_documents(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Scores are log10 probabilities of the whole text and its end.  A null or
    empty text is its end alone; a null id counts as an empty text for the
    held-out rule.  Repeated rows are learnt from and scored once each.  An
    empty table gives no rows; with no training text all counts are 0.
    """
    blocks = encode(docs)
    counts = word_counts(blocks)
    model, tokens, words = train(blocks, counts, states, rounds)
    local = (blocks.select("block", F.posexplode("vocab").alias("i", "word")).join(counts.select("word", "c"), "word")
             .where("c > 0").select(F.col("block").alias("home"), "i", "c"))
    return blocks.drop("train").groupBy("block").cogroup(local.groupBy("home")).applyInArrow(
        _scorer(model, tokens, words),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
