"""Language-model scores: a gated recurrent network over words with a class-factored softmax.

* Counts of all words of all training texts, as a table; nothing of it is capped. Words are parted and counted by
  Arrow for whole columns of texts, and looked up once for all places where they stand in a piece.
* Vocabulary of the network: the ``HEADS`` most frequent words have input rows and places in head
  classes; every other word, seen or not, belongs to one of ``ENDINGS`` endings, and endings to tail
  classes. Which words and endings go together comes from how often they share a text.
* P(word) = P(class | state) x P(word | class, state) in head classes, and in tail classes
  P(class | state) x (c + 0.1) / (N_class + 0.1 (V_class + 1)), with counts over all training texts.
* Training: truncated backpropagation in numpy over every training text, each used once. Texts are dealt to
  shards of about ``SHARD_TOKENS`` tokens by a hash of the id and ordered within, so the weights follow
  from the texts and not from how they are stored. In each of ``ROUNDS`` rounds all shards start from the
  same weights and optimiser state, and what they end with is averaged by tokens seen, a few at a time.
* Texts become numbers once, in files: the ``KNOWN`` most frequent words are looked up in a broadcast table of
  bounded size, the rest become the numbers of their endings and are joined with the counts by word. Classes,
  training and scores read the numbers.
* Scoring: whole texts, the state carried from window to window.

Defined results: null and empty texts are one end token; repeated rows are scored on their own and
alike; rows without an id are held out, never learnt from; with no training texts, or no texts at all,
counts are zero and the network keeps its first weights.
"""

from __future__ import annotations

import functools
import itertools
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedmart.llm import gru
from feedmart.llm.common import crc_bucket, landed

WIDTH = 24
HEADS, MEMBERS = 1024, 32
ENDINGS, TAILS = 1024, 32
ANCHORS = 64
KNOWN, KNOWN_BYTES = 1 << 17, 64
ROUNDS = 3
SHARD_TOKENS, MOST_SHARDS = 1 << 22, 4096
LANES, STEPS, RATE = 256, 32, 0.02
#: Shards whose weights are averaged in one task, and at most so many rows that come to the driver.
FAN_IN = 16
#: The word no text can hold: it ends every text.
END = b"\n"
#: Tokens a worker trains on at a time, and scores at a time; bytes of text it counts or numbers at a time. Lanes
#: are long then: a text of many words holds up the others less.
PIECE, SCORED, READ = 3 << 18, 3 << 20, 16 << 20
#: Texts whose words are counted in one block.
BLOCK = 64
_EDGE = b".,;:!?%$&#*|\"')("


def ending(word: bytes) -> int:
    """The ending of a word: its last three bytes, and whether punctuation follows."""
    bare = word.rstrip(_EDGE)
    return _ending(bare[-3:], len(bare) < len(word))


def _ending(last: bytes, followed: bool) -> int:
    return zlib.crc32(last + (b"." if followed else b"")) % ENDINGS


def endings(words: pa.Array) -> np.ndarray:
    """The endings of an Arrow array of words."""
    bare = pc.ascii_rtrim(words.view(pa.string()), _EDGE.decode()).view(pa.binary())
    last = pc.binary_slice(bare, -3).dictionary_encode()
    either = np.array([(_ending(x, False), _ending(x, True)) for x in last.dictionary.to_pylist()], np.int64).reshape(-1, 2)
    return either[last.indices.to_numpy(), pc.less(pc.binary_length(bare), pc.binary_length(words)).to_numpy(zero_copy_only=False).astype(np.int64)]


def pieces(batches: Iterator[pa.RecordBatch], column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that their texts come to about ``most`` bytes."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(), dtype=np.int64)
        at = 0
        while at < batch.num_rows:  # the text that reaches ``most`` is the last of its piece
            upto = min(batch.num_rows, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most)) + 1)
            yield batch.slice(at, upto - at)
            at = upto


def words_in(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The words of all texts of a column, as ``lower_words_of`` gives them, one text after the other; and where
    the words of each text begin, with the end of the last."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column.fill_null("")))
    words, starts = lists.flatten(), lists.offsets.to_numpy()
    there = pc.greater(pc.binary_length(words), 0)  # white space at an end of a text leaves an empty word
    before = np.concatenate([[0], np.cumsum(there.to_numpy(zero_copy_only=False))])
    return before[starts - starts[0]], words.filter(there).cast(pa.binary())


def counted(train: DataFrame) -> DataFrame:
    """(word, c) over all rows (text), the end token with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 0, READ):
            c = words_in(batch.column(0))[1].value_counts()
            word = pa.concat_arrays([c.field("values"), pa.array([END], pa.binary())])
            yield pa.RecordBatch.from_arrays([word, pa.concat_arrays([c.field("counts"), pa.array([batch.num_rows], pa.int64())])], ["word", "c"])

    return train.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Known:
    """The words with numbers, by falling count. A word without a number goes by its ending ``e``, as -1 - e: so
    arrays that hold the known words and then the endings backwards are looked up by either."""

    words: dict[bytes, int]
    count: np.ndarray
    total: int  # N
    distinct: int  # V

    @functools.cached_property
    def listed(self) -> pa.Array:
        """The words in the order of their numbers."""
        return pa.array(list(self.words), pa.binary())

    def numbers(self, words: list[bytes] | pa.Array) -> np.ndarray:
        words = words if isinstance(words, pa.Array) else pa.array(words, pa.binary())
        found = pc.index_in(words, value_set=self.listed)
        out, unknown = found.fill_null(-1).to_numpy().astype(np.int32), found.is_null()
        out[out < 0] = -1 - endings(words.filter(unknown))
        return out

    def by_number(self, of_known: np.ndarray, of_ending: np.ndarray) -> np.ndarray:
        return np.concatenate([of_known, of_ending[::-1]])


@dataclass
class Vocabulary:
    """What the network needs to know about the known words and the endings."""

    known: Known
    tokens: np.ndarray  # (input, class, member) by number
    rest: np.ndarray  # log10 of a tail word's share of its class by number, without counts of unknown words
    end: np.ndarray  # (input, class, member) of the end
    member_count: np.ndarray  # training tokens of each head word by class and member
    tail_n: np.ndarray  # tokens of each tail class in training
    heads: int

    @property
    def total(self) -> int:
        return self.known.total

    @property
    def head_classes(self) -> int:
        return -(-self.heads // MEMBERS)

    @property
    def begin(self) -> int:
        """The input row that begins a text."""
        return self.heads + ENDINGS


def _together(train: DataFrame, place: np.ndarray, heads: int) -> np.ndarray:
    """How often each head word and each ending shares a text with each anchor, the first head words. ``place``
    tells the row of a number. In whole numbers, so that the sums are the same in any order."""
    rows, anchors = heads + ENDINGS, min(ANCHORS, heads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((rows, anchors), np.int64)
        for batch in batches:
            texts_of = [place[t] for t in _arrays(batch.column(0))]
            for at in range(0, len(texts_of), BLOCK):
                block = texts_of[at : at + BLOCK]
                n = np.array([len(t) for t in block])
                cells = np.concatenate(block) + np.repeat(np.arange(len(block)) * rows, n)
                c = np.bincount(cells, minlength=len(block) * rows).reshape(-1, rows)
                near = (c[:, :anchors] << 16) // np.maximum(n, 1)[:, None]
                # exact: sums of whole numbers below 2 ** 53
                sums += (c.T.astype(float) @ near.astype(float)).astype(np.int64)
        k = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (k, *sums[k].T)], ["k", *names])

    names = [f"x{j}" for j in range(anchors)]
    summed = (
        train.select("tokens")
        .mapInArrow(run, ", ".join(f"{x} long" for x in ("k", *names)))
        .groupBy("k")
        .agg(*(F.sum(x).alias(x) for x in names))
        .collect()  # a row per head word and ending
    )
    out = np.zeros((rows, max(anchors, 1)))
    for r in summed:
        out[r["k"], :anchors] = [r[x] / (1 << 16) for x in names]
    return out


def _clusters(vectors: np.ndarray, weight: np.ndarray, k: int) -> np.ndarray:
    """Cluster numbers of rows by direction, by k-means from evenly spread starts."""
    share = vectors / np.maximum(vectors.sum(axis=1, keepdims=True), 1e-9)
    x = np.sqrt(share)
    k = min(k, len(x))
    rng = np.random.default_rng(2)
    centres = x[rng.choice(len(x), k, replace=False, p=weight / weight.sum())]
    label = np.zeros(len(x), int)
    for _ in range(15):
        label = (x @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
        for j in range(k):
            own = label == j
            if own.any():
                centres[j] = np.average(x[own], axis=0, weights=weight[own])
    return label


def _frequent(counts: DataFrame) -> DataFrame:
    """The words with the counts of the ``KNOWN`` most frequent ones, and hardly more: otherwise each
    task would send its own ``KNOWN`` words to the driver."""
    grade = F.floor(F.log2("c") * 8)
    reached, lowest = 0, 0
    for r in sorted(counts.groupBy(grade.alias("grade")).count().collect(), reverse=True):  # 512 rows at most
        reached, lowest = reached + r["count"], r["grade"]
        if reached >= KNOWN:
            break
    return counts.filter(grade >= lowest)


def known_words(counts: DataFrame) -> Known:
    n, v = counts.agg(F.sum("c"), F.count("*")).first()
    usual = counts.filter(F.octet_length("word") <= KNOWN_BYTES)
    top = _frequent(usual).orderBy(F.desc("c"), "word").limit(KNOWN).collect()  # so many words of so many bytes
    words, count = {bytes(r["word"]): k for k, r in enumerate(top)}, np.array([r["c"] for r in top], float)
    if END not in words:  # more than KNOWN words are more frequent
        words[END] = len(words)
        count = np.append(count, float(counts.filter(F.col("word") == F.lit(END)).agg(F.sum("c")).first()[0] or 0))
    return Known(words, count, int(n or 0), int(v or 0))


def vocabulary(counts: DataFrame, train: DataFrame, known: Known | None = None) -> Vocabulary:
    """``train`` has the numbers of the texts (id, tokens), or the texts themselves."""
    known = known or known_words(counts)
    words, count = known.words, known.count
    order = [END, *(w for w in words if w != END)][:HEADS]
    heads = {w: k for k, w in enumerate(order)}
    ending_of = endings(known.listed)
    place = np.fromiter((heads.get(w, -1) for w in words), np.int64, len(words))
    is_head = place >= 0
    near = _together(
        _numbered(train, known), known.by_number(np.where(is_head, place, len(heads) + ending_of), len(heads) + np.arange(ENDINGS)), len(heads)
    )
    head_n = np.array([count[words[w]] for w in order]) + 0.1
    # head words that go together fill a class of MEMBERS; endings that go together are a tail class
    by_cluster = np.lexsort((-head_n, _clusters(near[: len(heads)] + 1e-6, head_n, 16)))
    input_of = np.empty(len(heads), int)
    input_of[by_cluster] = np.arange(len(heads))
    tails = _clusters(near[len(heads) :] + 1e-6, near[len(heads) :].sum(axis=1) + 0.1, TAILS)
    head_classes = -(-len(heads) // MEMBERS)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, heads = np.zeros((2, TAILS), np.int64), pa.array(order, pa.binary())
        for batch in batches:
            batch = batch.filter(pc.invert(pc.is_in(batch.column(0), value_set=heads)))
            tail = tails[endings(batch.column(0))]
            np.add.at(got[0], tail, batch.column(1).to_numpy())
            got[1] += np.bincount(tail, minlength=TAILS)
        yield pa.RecordBatch.from_pydict({"k": list(range(TAILS)), "n": got[0], "v": got[1]})

    tail_n, tail_v = np.zeros(TAILS), np.zeros(TAILS)
    for r in counts.select("word", "c").mapInArrow(sums, "k long, n long, v long").groupBy("k").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        tail_n[r["k"]], tail_v[r["k"]] = r["n"], r["v"]
    own = input_of[np.where(is_head, place, 0)]
    of_ending = np.stack([len(heads) + np.arange(ENDINGS), head_classes + tails, np.full(ENDINGS, -1)], axis=1)
    of_known = np.where(is_head[:, None], np.stack([own, own // MEMBERS, own % MEMBERS], axis=1), of_ending[ending_of])
    members = np.zeros((head_classes, MEMBERS))
    members[own[is_head] // MEMBERS, own[is_head] % MEMBERS] = count[is_head] + 0.1
    below = np.log10(tail_n + 0.1 * (tail_v + 1))[tails]
    rest = np.where(is_head, 0, np.log10(count + 0.1) - below[ending_of])
    return Vocabulary(known, known.by_number(of_known, of_ending).astype(np.int32), known.by_number(rest, -below),
                      of_known[words[END]].astype(np.int32), members, tail_n, len(heads))


def first_weights(vocab: Vocabulary) -> gru.Params:
    class_n = np.concatenate([vocab.member_count.sum(axis=1), vocab.tail_n])
    return gru.start(vocab.heads + ENDINGS + 1, WIDTH, len(class_n), vocab.head_classes, MEMBERS, class_n, vocab.member_count)


def encoded(tokens: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Rows of (input before, class, member) of a text's numbers and its end."""
    rows, found = np.empty((len(tokens) + 1, 3), np.int32), vocab.tokens[tokens]
    rows[0, 0], rows[1:, 0] = vocab.begin, found[:, 0]
    rows[:-1, 1:], rows[-1, 1:] = found[:, 1:], vocab.end[1:]
    return rows


def _arrays(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, np.int32) for b in column.to_pylist()]


def _numbered(docs: DataFrame, known: Known) -> DataFrame:
    """Per row (id, learn, text) its numbers, what follows from counts of known words, and the unknown words. Rows
    that have numbers already are left as they are."""
    if "tokens" in docs.columns:
        return docs
    held = docs.sparkSession.sparkContext.broadcast(known)
    rows = docs.select("id", F.col("learn") if "learn" in docs.columns else F.lit(True).alias("learn"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        base_below = math.log10(known.total + 0.1 * (known.distinct + 1))
        none = np.zeros(ENDINGS)
        logs, seen = known.by_number(np.log10(known.count + 0.1), none), known.by_number(known.count > 0, none).astype(np.int64)
        end, uid = known.words[END], TaskContext.get().partitionId() << 40
        for batch in pieces(batches, 2, READ):
            starts, words = words_in(batch.column(2))
            coded = words.dictionary_encode()
            codes, different = coded.indices.to_numpy(), max(1, len(coded.dictionary))
            tokens = known.numbers(coded.dictionary)[codes]
            of_text, n = [tokens[a:b] for a, b in itertools.pairwise(starts)], np.diff(starts) + 1
            there = np.concatenate([[0], np.cumsum(seen[tokens])])
            # the unknown words of each text, once, with how often they stand there
            unknown = np.flatnonzero(tokens < 0)
            pairs, times = np.unique((np.searchsorted(starts, unknown, "right") - 1) * different + codes[unknown], return_counts=True)
            firsts = pa.array(np.searchsorted(pairs, np.arange(len(starts)) * different), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(uid, uid + len(n)), pa.int64()),
                    batch.column(0),
                    batch.column(1),
                    pa.array([t.tobytes() for t in of_text], pa.binary()),
                    pa.array(n, pa.int64()),
                    pa.array(np.diff(there[starts]) + seen[end], pa.int64()),
                    pa.array([float(logs[t].sum() + logs[end]) - base_below * (len(t) + 1) for t in of_text], pa.float64()),
                    pa.ListArray.from_arrays(firsts, coded.dictionary.take(pa.array(pairs % different))),
                    pa.ListArray.from_arrays(firsts, pa.array(times, pa.int64())),
                ],
                ["uid", "id", "learn", "tokens", "n_tokens", "n_known", "base", "words", "times"],
            )
            uid += len(n)

    kind = docs.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"uid long, id {kind}, learn boolean, tokens binary, n_tokens long, n_known long, base double, words array<binary>, times array<long>"
    )


def _flat(p: gru.Params) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _unflat(flat: np.ndarray, like: gru.Params) -> gru.Params:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def trained(train: DataFrame, vocab: Vocabulary, rounds: int = ROUNDS) -> gru.Params:
    """Weights after ``rounds`` rounds over rows (id, tokens), or (id, text); every text is used in one of them."""
    sc = train.sparkSession.sparkContext
    held, state, step = sc.broadcast(vocab), [first_weights(vocab)], 0
    state += [{k: np.zeros_like(x) for k, x in state[0].items()} for _ in range(2)]  # Adam's two means
    shards = min(MOST_SHARDS, max(1, -(-vocab.total // SHARD_TOKENS)))

    def hashed(salt: int) -> Column:
        return F.xxhash64("id", F.lit(salt))

    dealt = _numbered(train, vocab.known).select(
        F.pmod(hashed(29), F.lit(shards)).cast("int").alias("shard"),
        hashed(31).alias("key"),
        F.pmod(hashed(23), F.lit(rounds)).alias("turn"),
        "tokens",
    )
    for turn in range(rounds):
        sent, rate = sc.broadcast((state, step)), RATE * 0.6**turn

        def run(batches: Iterator[pa.RecordBatch], sent=sent, rate=rate) -> Iterator[pa.RecordBatch]:
            start, taken = sent.value
            for shard, some in itertools.groupby(_by_shard(batches), key=lambda x: x[0]):
                trainer = gru.Trainer(*start, taken, LANES, STEPS)
                for _, texts_of in some:
                    trainer.feed([encoded(t, held.value) for t in texts_of], rate)
                flat = np.concatenate([_flat(x) for x in (trainer.p, trainer.m, trainer.v)]).astype("f4")
                yield _averaged_row(shard, trainer.seen, trainer.step, flat)

        mine = dealt.filter(F.col("turn") == turn).drop("turn").repartitionById(shards, F.col("shard"))
        rows = mine.sortWithinPartitions("shard", "key", "tokens").mapInArrow(run, _AVERAGED)
        left = shards
        while left > FAN_IN:
            rows = rows.groupBy(F.expr(f"shard div {FAN_IN}").alias("next")).applyInArrow(_averaged, _AVERAGED)
            left = -(-left // FAN_IN)
        found = rows.collect()  # FAN_IN rows at most
        if found:
            mean = _mean([(r["shard"], r["seen"], r["step"], np.frombuffer(r["w"], "f4")) for r in found])
            step, flat = mean[1], mean[2]
            state = [_unflat(x, state[0]) for x in np.split(flat, 3)]
    return state[0]


_AVERAGED = "shard long, seen long, step long, w binary"


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(shard, texts) of rows ordered by shard, cut by tokens alone and not by batches."""
    held, size, of = [], 0, None
    for batch in batches:
        for shard, tokens in zip(batch.column("shard").to_pylist(), _arrays(batch.column("tokens")), strict=True):
            if held and (shard != of or size >= PIECE):
                yield of, held
                held, size = [], 0
            of = shard
            held.append(tokens)
            size += len(tokens)
    if held:
        yield of, held


def _mean(rows: list[tuple[int, int, int, np.ndarray]]) -> tuple[int, int, np.ndarray]:
    """(tokens, mean steps, weights averaged by tokens), in the order of the shards."""
    rows = sorted(rows, key=lambda r: r[0])
    seen = sum(r[1] for r in rows)
    total = np.zeros(len(rows[0][3]))
    for _, n, _, w in rows:
        total += w * np.float64(n / seen)
    return seen, sum(r[1] * r[2] for r in rows) // seen, total.astype("f4")


def _averaged_row(shard: int, seen: int, step: int, w: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"shard": [shard], "seen": [seen], "step": [step], "w": pa.array([w.tobytes()], pa.binary())})


def _averaged(group: pa.Table) -> pa.Table:
    """One row for up to ``FAN_IN`` shards."""
    held = group.to_pylist()
    seen, step, w = _mean([(r["shard"], r["seen"], r["step"], np.frombuffer(r["w"], "f4")) for r in held])
    return pa.Table.from_batches([_averaged_row(min(r["shard"] for r in held) // FAN_IN, seen, step, w)])


def _scores(numbers: DataFrame, vocab: Vocabulary, weights: gru.Params) -> DataFrame:
    """Per row of ``_numbered`` the score that follows without the counts of unknown words."""
    sc = numbers.sparkSession.sparkContext
    held, sent = sc.broadcast(vocab), sc.broadcast(weights)
    kept = ["uid", "id", "n_tokens", "n_known", "base"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = held.value
        for batch in batches:
            tokens = _arrays(batch.column(len(kept)))
            score = np.array([vocab.rest[t].sum() for t in tokens])
            ends, at = np.cumsum([len(t) + 1 for t in tokens]), 0
            while at < len(tokens):  # texts of about SCORED tokens
                upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SCORED, "right")))
                score[at:upto] += gru.scores(sent.value, [encoded(t, vocab) for t in tokens[at:upto]]) / math.log(10)
                at = upto
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(kept))), pa.array(score, pa.float64())], [*kept, "score"])

    kind = numbers.schema["id"].dataType.simpleString()
    return numbers.select(*kept, "tokens").mapInArrow(run, f"uid long, id {kind}, n_tokens long, n_known long, base double, score double")


def scored(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: n_tokens, n_known, train_tokens, base_score, score. ``learn`` says what may be learnt from."""
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    counts = landed(counted(named.filter("learn")), "word-counts")
    known = known_words(counts)
    numbers = landed(_numbered(named, known), "lm-numbers")
    train = numbers.filter("learn").select("id", "tokens")
    vocab = vocabulary(counts, train, known)
    parts = _scores(numbers, vocab, trained(train, vocab))
    unknown = numbers.select("uid", F.explode(F.arrays_zip("words", "times")).alias("_")).select("uid", F.col("_.words").alias("word"), F.col("_.times").alias("n"))
    c = F.coalesce("c", F.lit(0))
    rare = (
        unknown.join(counts, "word", "left")
        .groupBy("uid")
        .agg(F.sum(F.col("n") * F.log10(c + 0.1)).alias("logs"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("there"))
    )
    logs, there = F.coalesce("logs", F.lit(0.0)), F.coalesce("there", F.lit(0))
    return parts.join(rare, "uid", "left").select(
        F.col("id").alias(id_col),
        "n_tokens",
        (F.col("n_known") + there).alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )


def learning_fold(id_col: str = "doc_id") -> Column:
    """Rows whose id does not fall into fold 0 of 10."""
    return crc_bucket(F.col(id_col), 10) != 0
