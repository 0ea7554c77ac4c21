"""Language-model scoring by a probabilistic suffix tree over words.

A text's symbols are its words (A-Z lower-cased) and one end; a word that
training never saw is the unknown symbol.  Contexts are the one to ``DEPTH``
symbols before a position (a start symbol stands before the text).  A context
or a pair of a context and its next symbol counts if training holds it
``MIN_PAIRS`` times or more; a context is retained if the divergence of its
next-symbol distribution from that of its longest proper suffix passes a
test: the likelihood gain ``N * KL`` must exceed ``followers / 2 * ln N``.
Suffixes of retained contexts stay.  Next-symbol distributions are
interpolated with the suffix's (Witten-Bell) down to the root, which discounts
every word's count by ``d`` and gives the freed mass to the unknown symbol;
all of them sum to one.  Each symbol is scored in the state of the longest
suffix of what stands before it.

The tree grows with the corpus, so nothing of it but the root's few numbers
passes through the driver.  Texts are read once, into chunks of word numbers
(:class:`Tokens`), dealt by chunk with all answers beside them, so that only
messages are shuffled.  The parts of the tree meet in exchanges of all chunks' keys
(:mod:`chunks`): the words; then, one length after the other, the pairs, whose
sums return to every chunk that holds them, and the contexts, whose followers
are added up from the pairs' first senders, tested, and returned; last the
suffixes of retained contexts.  A chunk sends a key once, whatever its
frequency, and only pairs whose context counts and whose suffix's pair does.

Defined results: a null text is empty (one end symbol); with no training row
everything is unknown, with probability 1; repeated rows are scored and
counted each; a null id counts as the largest, its row as ``train`` says.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clusterfold.llm import chunks as C
from clusterfold.llm import words as W
from clusterfold.llm.frames import keep_memory, lean, saved, setting

DEPTH = 3
MIN_PAIRS = 2  # occurrences of a context, and of a context with its next symbol
KEY_BYTES = 25.0  # of text for each distinct word of a chunk, about
PAIR_BYTES = 8.0  # of text for each distinct pair of one length, about
GAIN_UNIT, MASS_UNIT = 1 << 10, 1 << 32  # sums of whole units do not depend on their order
START, END = W.mix(np.array([1, 2], W.U64))
_MIX_CONTEXT, _MIX_PAIR = W.U64(0xA0761D6478BD642F), W.U64(0xE7037ED1A0B428DB)


class Keys:
    """Membership and places in a set of 64-bit keys."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.sort(keys)
        self.bits = min(22, max(12, len(keys).bit_length() + 4))
        self.seen = np.zeros(1 << self.bits, dtype=bool)
        self.seen[self.keys >> W.U64(64 - self.bits)] = True

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Place of each key, or -1."""
        out = np.full(len(keys), -1, np.int64)
        near = np.flatnonzero(self.seen[keys >> W.U64(64 - self.bits)])
        if len(near):
            place = np.minimum(np.searchsorted(self.keys, keys[near]), len(self.keys) - 1)
            hit = self.keys[place] == keys[near]
            out[near[hit]] = place[hit]
        return out


def longer(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Key of a context with one more symbol before it."""
    return W.mix(context * _MIX_CONTEXT + symbol)


def pair(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    return W.mix(context * _MIX_PAIR ^ symbol)


_EMPTY = W.U64(0)


TOKENS = "chunk long, n_bytes long, ids binary, nulls binary, marks binary, counts binary, words binary, places binary"


class Tokens:
    """A chunk's words as numbers: its distinct words' keys, ascending, and
    each word's place among them, text after text."""

    def __init__(self, row: dict):
        self.number = row["chunk"]
        self.ids, self.nulls, self.marks = (np.frombuffer(row[name], kind) for name, kind in (("ids", np.int64), ("nulls", bool), ("marks", bool)))
        self.counts = np.frombuffer(row["counts"], np.int64)
        self.first = np.append(0, np.cumsum(self.counts))
        self.keys, self.place = np.cumsum(_expanded(row["words"], W.U64), dtype=W.U64), _expanded(row["places"])
        self.replies = row.get("replies")

    id_list = C.Chunk.id_list

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def a_word(self) -> np.ndarray:
        """Which of the places to predict are words; a text's last is its end."""
        out = np.ones(len(self.place) + len(self.counts), bool)
        out[self.first[1:] + np.arange(len(self.counts))] = False
        return out

    def trained(self) -> np.ndarray:
        """Training counts of the distinct words."""
        return np.bincount(self.place[np.repeat(self.marks, self.counts)], minlength=len(self.keys))


def _tokenised(batches):
    for row in C.rows_of(batches):
        chunk = C.Chunk(row)
        low = W.LOWER[chunk.data]
        words = W.scan(low, chunk.offsets, W.SPACED)
        keys, _, place = _distinct(W.word_hashes(low, words))
        own = [row[name] for name in ("chunk", "n_bytes", "ids", "nulls", "marks")] + [words.counts.tobytes(), _squeezed(np.diff(keys, prepend=_EMPTY)), _squeezed(place)]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64() if k < 2 else pa.binary()) for k, x in enumerate(own)], names=[x.split()[0] for x in TOKENS.split(", ")])


def symbols(chunk: Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, places to predict, their texts): ``DEPTH`` starts, the words, an end."""
    own = np.repeat(np.arange(len(chunk.counts)), chunk.counts + 1)
    wanted = np.arange(len(own))
    wanted += DEPTH * (own + 1)
    out = np.full(len(own) + DEPTH * len(chunk.counts), START, W.U64)
    here = np.full(len(own), END)
    here[chunk.a_word()] = chunk.keys[chunk.place]
    out[wanted] = here
    return out, wanted, own


def _send_words(n_buckets: int):
    def send(chunk: Tokens):
        counts = chunk.trained()
        for bucket, lo, hi in zip(*(x.tolist() for x in C.by_bucket(chunk.keys, n_buckets))):
            yield bucket, [chunk.keys[lo:hi].tobytes(), zstandard.compress(counts[lo:hi].astype("<u4").tobytes(), 1)]

    return send


def _sums(parts):
    keys = [np.frombuffer(p[0], np.uint64) for p in parts]
    every = np.concatenate(keys)
    counts = np.concatenate([np.frombuffer(zstandard.decompress(p[1]), "<u4") for p in parts]).astype(np.int64)
    order = np.argsort(every, kind="stable")
    ascending = every[order]
    first = np.flatnonzero(np.append(True, ascending[1:] != ascending[:-1]))
    return keys, ascending[first], order, first, np.add.reduceat(counts[order], first)


def _answer_words(parts):
    keys, _, order, first, sums = _sums(parts)
    out = np.empty(len(order), np.int64)
    out[order] = np.repeat(sums, np.diff(np.append(first, len(order))))
    return [zstandard.compress(x.astype("<u8").tobytes(), 1) for x in np.split(out, np.cumsum([len(k) for k in keys])[:-1])]


def _tally_words(parts):
    """Distinct trained words, those seen once and twice."""
    sums = _sums(parts)[4]
    return np.array([(sums > 0).sum(), (sums == 1).sum(), (sums == 2).sum()], np.int64).tobytes()


def _train_tokens(table: DataFrame) -> tuple[int, int]:
    """(symbols, ends) of the training rows."""

    def run(batches):
        for batch in batches:
            for own, marks in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                marks = np.frombuffer(marks, bool)
                ends = int(marks.sum())
                yield pa.RecordBatch.from_arrays([pa.array([int(np.frombuffer(own, np.int64)[marks].sum()) + ends], pa.int64()), pa.array([ends], pa.int64())], names=["n", "ends"])

    row = table.select("counts", "marks").mapInArrow(run, "n long, ends long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("ends"), F.lit(0))).first()
    return row[0], row[1]


@dataclass
class Level:
    """Contexts of one length: totals, the mass left to the suffix, and the
    probabilities of the pairs."""

    contexts: Keys
    left: np.ndarray
    pairs: Keys
    probability: np.ndarray


@dataclass
class Root:
    """Discounted word counts."""

    n: int
    distinct: int
    discount: float
    ends: int

    def probability(self, counts: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.ones(len(counts))
        return np.where(counts > 0, counts - self.discount, self.discount * self.distinct) / self.n


PAIRS, CONTEXTS, SUFFIXES = b"p", b"c", b"s"  # what a message holds


@dataclass
class Depth:
    """A chunk's places whose context of one length counts."""

    at: np.ndarray  # the places
    pairs: np.ndarray | None = None  # those that may be frequent: distinct, ascending
    first_of_pair: np.ndarray | None = None  # one of its places, as a number in ``at``
    trained: np.ndarray | None = None  # of a distinct pair in this chunk
    seen: np.ndarray | None = None  # a place's pair in training; 0 below MIN_PAIRS
    own: np.ndarray | None = None  # distinct pairs that this chunk adds to their context
    contexts: np.ndarray | None = None  # distinct, ascending
    context_of: np.ndarray | None = None
    total: np.ndarray | None = None
    kinds: np.ndarray | None = None
    kept: np.ndarray | None = None
    retained: np.ndarray | None = None


class Positions:
    """A chunk's places to predict, with all that the exchanges so far
    answered: 0 the words, ``d`` the pairs of length ``d`` (and the contexts
    of length ``d - 1``), ``DEPTH + 2`` the suffixes of retained contexts.
    What the next messages do not need is not derived again."""

    def __init__(self, chunk: Tokens, root: Root, n_words: int, n_keys: int):
        self.chunk, self.n_keys = chunk, n_keys
        keys, place = chunk.keys, chunk.place
        count = np.zeros(len(keys), np.int64)
        answers = {r["bucket"]: r["reply"] for r in chunk.replies[0]}
        for bucket, lo, hi in zip(*(x.tolist() for x in C.by_bucket(keys, n_words))):
            count[lo:hi] = np.frombuffer(zstandard.decompress(answers[bucket]), "<u8")
        self.count = count[place]
        data, wanted, self.text = symbols(chunk)
        each = np.full(len(wanted), root.ends, np.int64)
        here = data[wanted]
        a_word = chunk.a_word()
        each[a_word] = self.count
        self.p = [root.probability(each)]
        self.depths: list[Depth] = []
        size = len(wanted)
        first = chunk.first[:-1] + np.arange(len(chunk.counts))
        at, context = np.arange(size), np.full(size, _EMPTY)
        before, at_start = each, root.ends
        prior, n_ids = np.full(size, len(keys)), len(keys) + 1
        prior[a_word] = place
        done = len(chunk.replies)
        for d in range(1, min(done, DEPTH) + 1):
            total = _shifted(before, first, at_start)[at]
            live = np.flatnonzero(total >= MIN_PAIRS)
            at, total = at[live], total[live]
            context = longer(context[live], data[wanted[at] - d])
            depth = Depth(at)
            self.depths.append(depth)
            if d < DEPTH or done != DEPTH + 2:  # the suffixes need no pairs of the longest contexts
                # a pair is at most as frequent as that of the suffix: others are not asked for
                asked = np.flatnonzero(before[at] >= MIN_PAIRS)
                ask = at[asked]
                pairs, index, of = _distinct(pair(context[asked], here[ask]))
                depth.pairs = pairs
                if d >= done:
                    depth.trained = np.bincount(of[chunk.marks[self.text[ask]]], minlength=len(pairs))
                    break
                answer = _answered(chunk.replies[d], pairs, n_keys)[0]
                n = answer >> 1
                n[n < MIN_PAIRS] = 0
                depth.seen = np.zeros(len(at), np.int64)
                depth.seen[asked] = n[of]
                if d + 1 == done or done > DEPTH + 2:
                    depth.first_of_pair, depth.own = asked[index], np.flatnonzero((answer & 1 == 1) & (n > 0))
            # a context is what the place before it holds: its word, or its pair
            ids = _shifted(prior, first, n_ids - 1)[at]
            sample = np.full(n_ids, -1)
            sample[ids] = np.arange(len(at))
            used = np.flatnonzero(sample >= 0)
            sample = sample[used]
            order, depth.contexts = _ordered(context[sample])
            rank = np.empty(n_ids, np.int64)
            rank[used[order]] = np.arange(len(used))
            depth.context_of, depth.total = rank[ids], total[sample[order]]
            if d < DEPTH:
                prior, n_ids = np.full(size, len(pairs)), len(pairs) + 1
                prior[ask] = of
                before, at_start = np.zeros(size, np.int64), 0
                before[at] = depth.seen
            if d + 1 >= done:
                continue
            depth.kinds, kept = _answered(chunk.replies[d + 1], depth.contexts, n_keys, n_keys, 2)
            depth.kept, depth.retained = kept >> 1, kept & 1 == 1
            if done == DEPTH + 2:
                continue
            # a context without followers leaves all to its suffix
            share = 1.0 / np.maximum(depth.kept + depth.kinds, 1)
            left = np.where(depth.kinds > 0, depth.kinds * share, 1.0)
            p = self.p[-1].copy()
            p[at] = depth.seen * share[depth.context_of] + left[depth.context_of] * p[at]
            self.p.append(p)
        if done > DEPTH + 2:
            own = self.suffixes()
            keys = np.concatenate([k for _, k in own])
            order, under = np.argsort(keys), np.zeros(len(keys), bool)
            under[order] = _answered(chunk.replies[DEPTH + 2], keys[order], n_keys)[0] == 1
            for depth, (picked, _), flags in zip(self.depths, own, np.split(under, np.cumsum([len(k) for _, k in own])[:-1])):
                depth.retained = depth.retained.copy()
                depth.retained[picked] = flags

    def suffixes(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """By length, the contexts that did not pass the test themselves: (places in ``contexts``, keys)."""
        found = [np.flatnonzero(~depth.retained & (depth.kinds > 0)) for depth in self.depths[:-1]]
        return [(own, depth.contexts[own]) for own, depth in zip(found, self.depths)]

    def messages(self):
        """What this chunk sends next: (bucket, parts)."""
        step = len(self.chunk.replies)
        if step <= DEPTH:
            depth = self.depths[step - 1]
            yield from _sent(PAIRS, depth.pairs, [depth.trained], self.n_keys)
        if 1 < step <= DEPTH + 1:
            depth, size = self.depths[step - 2], len(self.depths[step - 2].contexts)
            place = depth.first_of_pair[depth.own]
            context, n, q = depth.context_of[place], depth.seen[place], self.p[step - 2][depth.at[place]]
            gain = n * np.log(n / depth.total[context] / q)
            kinds, kept, mass, gain = (np.bincount(context, weights=w, minlength=size) for w in (np.ones(len(n)), n, q, gain))
            yield from _sent(CONTEXTS, depth.contexts, [np.where(kinds > 0, depth.total, 0), kinds, kept, np.rint(mass * MASS_UNIT), np.rint(gain * GAIN_UNIT)], self.n_keys, self.n_keys)
        if step == DEPTH + 2:
            found, under = [], np.zeros(len(self.text), bool)
            for depth, (picked, keys) in reversed(list(zip(self.depths, [*self.suffixes(), (None, None)]))):
                if picked is not None:
                    found.append((keys, np.bincount(depth.context_of, weights=under[depth.at], minlength=len(depth.contexts))[picked] > 0))
                under[depth.at] |= depth.retained[depth.context_of]
            keys, flags = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(keys)
            yield from _sent(SUFFIXES, keys[order], [flags[order]], self.n_keys)

    def probability(self) -> np.ndarray:
        """Of each place's symbol, in the state of the longest suffix before it."""
        out, live = self.p[0].copy(), np.ones(len(self.text), bool)
        for depth, p in zip(self.depths, self.p[1:]):
            here = np.zeros(len(live), bool)
            here[depth.at] = depth.retained[depth.context_of]
            live &= here
            out[live] = p[live]
        return out


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ascending distinct keys, a place of each, each place's key)."""
    order, ascending = _ordered(keys)
    new = np.append(True, ascending[1:] != ascending[:-1])[: len(keys)]
    place = np.cumsum(new)
    place -= 1
    of = np.empty(len(keys), np.int64)
    of[order] = place
    new = np.flatnonzero(new)
    return ascending[new], order[new], of


def _ordered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, ascending keys).  Numbers of the keys' high bits and their
    places are sorted as such, faster than places by key; the few chunks with
    keys that only differ below are sorted plainly."""
    low = W.U64((1 << len(keys).bit_length()) - 1)
    both = keys & ~low
    both |= np.arange(len(keys), dtype=W.U64)
    both.sort()
    both &= low
    order = both.view(np.int64)
    ascending = keys[order]
    if (ascending[1:] < ascending[:-1]).any():
        order = np.argsort(keys, kind="stable")
        ascending = keys[order]
    return order, ascending


def _shifted(values: np.ndarray, first: np.ndarray, start: int) -> np.ndarray:
    """What stands one place before, and ``start`` before each text."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[first] = start
    return out


def _sent(kind: bytes, keys: np.ndarray, columns: list, n_buckets: int, shift: int = 0):
    """Messages of ascending keys; contexts have buckets of their own."""
    for bucket, lo, hi in zip(*(x.tolist() for x in C.by_bucket(keys, n_buckets))):
        yield bucket + shift, [kind, _squeezed(np.diff(keys[lo:hi], prepend=_EMPTY)), _squeezed(np.stack([c[lo:hi] for c in columns]).astype("<i8"))]


def _squeezed(numbers: np.ndarray) -> bytes:
    """Eight-byte numbers, compressed byte by byte, without the high bytes that all lack."""
    numbers = np.ascontiguousarray(numbers).ravel().view(W.U64)
    n, width = len(numbers), max(1, (int(numbers.max(initial=0)).bit_length() + 7) // 8)
    out = np.empty(1 + width * n, np.uint8)
    out[0] = width
    for k in range(width):
        out[1 + k * n : 1 + (k + 1) * n] = numbers >> W.U64(8 * k)
    return zstandard.compress(out.tobytes(), 1)


def _expanded(data: bytes, kind=np.int64) -> np.ndarray:
    raw = np.frombuffer(zstandard.decompress(data), np.uint8)
    planes = raw[1:].reshape(int(raw[0]), -1)
    out = planes[0].astype(W.U64)
    for k in range(1, len(planes)):
        out |= planes[k].astype(W.U64) << W.U64(8 * k)
    return out.view(kind)


def _answered(replies: list[dict], keys: np.ndarray, n_buckets: int, shift: int = 0, width: int = 1) -> np.ndarray:
    """The numbers that came back for ascending keys, a row for each column."""
    out = np.zeros((width, len(keys)), np.int64)
    by = {r["bucket"]: r["reply"] for r in replies}
    found, first, end = C.by_bucket(keys, n_buckets)
    for bucket, lo, hi in zip(found.tolist(), first.tolist(), end.tolist()):
        out[:, lo:hi] = _expanded(by[bucket + shift]).reshape(width, -1)
    return out


def _answer(parts):
    kind = parts[0][0]
    keys = [np.cumsum(_expanded(p[1], W.U64), dtype=W.U64) for p in parts]
    every, sizes = np.concatenate(keys), [len(k) for k in keys]
    rows = np.concatenate([_expanded(p[2]).reshape(-1, size) for p, size in zip(parts, sizes)], axis=1)
    order = np.argsort(every, kind="stable")
    ascending = every[order]
    first = np.flatnonzero(np.append(True, ascending[1:] != ascending[:-1]))
    rows, group = rows[:, order], np.repeat(np.arange(len(first)), np.diff(np.append(first, len(every))))
    if kind == PAIRS:  # the sum, and a mark for the first chunk that trains on it
        found = (np.add.reduceat(rows[0], first) << 1)[group][None]
        trains = np.flatnonzero(rows[0] > 0)
        found[0, trains[np.append(True, group[trains][1:] != group[trains][:-1])[: len(trains)]]] |= 1
    elif kind == CONTEXTS:
        total = np.maximum.reduceat(rows[0], first)
        kinds, kept, mass, gain = (np.add.reduceat(r, first) for r in rows[1:])
        rest, free = total - kept, 1 - mass / MASS_UNIT
        more = (rest > 0) & (free > 1e-6)
        gain = gain / GAIN_UNIT + np.where(more, rest * np.log(np.where(more, rest, 1) / np.maximum(total, 1) / np.where(more, free, 1)), 0.0)
        passed = (kinds > 0) & (gain > kinds / 2 * np.log(np.maximum(total, 1)))
        found = np.stack([kinds, kept << 1 | passed])[:, group]
    else:
        found = np.maximum.reduceat(rows[0], first)[group][None]
    out = np.empty_like(found)
    out[:, order] = found
    return [_squeezed(np.ascontiguousarray(x, "<i8")) for x in np.split(out, np.cumsum(sizes)[:-1], axis=1)]


def _swept(spark: SparkSession):
    """Each frame made inside drops its shuffle files once it is saved: those
    of all steps together are several times the text."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


@dataclass
class Tree:
    """The root, and the chunks with the answers of all exchanges."""

    root: Root
    chunks: DataFrame
    n_words: int
    n_keys: int
    n_parts: int

    def positions(self):
        """A function from a chunk of ``chunks`` to its positions."""
        root, n_words, n_keys = self.root, self.n_words, self.n_keys

        def of(chunk: Tokens) -> Positions:
            keep_memory()  # until the task ends
            return Positions(chunk, root, n_words, n_keys)

        return of

    @cached_property
    def levels(self) -> list[Level]:
        """The retained contexts by length, collected: to look into small trees."""
        of = self.positions()

        def run(batches):
            for row in C.rows_of(batches):
                own = of(Tokens(row))
                for d, depth in enumerate(own.depths):
                    place = depth.first_of_pair
                    context = depth.context_of[place]
                    ok = depth.retained[context]
                    place, context = place[ok], context[ok]
                    kinds, kept = depth.kinds[context], depth.kept[context]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(place), d)), pa.array(depth.contexts[context].view(np.int64)), pa.array(kinds / (kept + kinds)), pa.array(depth.pairs[ok].view(np.int64)),
                         pa.array(depth.seen[place]), pa.array(own.p[d + 1][depth.at[place]])], names=["d", "context", "left", "pair", "n", "p"])

        rows = self.chunks.mapInArrow(run, "d long, context long, left double, pair long, n long, p double").dropDuplicates(["d", "context", "pair"]).toPandas()
        levels = []
        for _, own in sorted(rows.groupby("d")):
            contexts, pairs = own.drop_duplicates("context"), own[own["n"] > 0]
            keys, known = (x.to_numpy(np.int64).view(W.U64) for x in (contexts["context"], pairs["pair"]))
            levels.append(Level(Keys(keys), contexts["left"].to_numpy()[np.argsort(keys)], Keys(known), pairs["p"].to_numpy()[np.argsort(known)]))
        return levels

    def probability(self, data: np.ndarray, place: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """As :meth:`Positions.probability`, for any symbols, from the
        collected levels; ``counts`` are the symbols' training counts."""
        out = self.root.probability(counts)
        live, context = np.arange(len(place)), np.full(len(place), _EMPTY)
        for k, level in enumerate(self.levels):  # from the suffix to longer contexts
            context = longer(context, data[place[live] - 1 - k])
            state = level.contexts.find(context)
            known = state >= 0
            live, context, state = live[known], context[known], state[known]
            if not len(live):
                break
            at = level.pairs.find(pair(context, data[place[live]]))
            out[live] = np.where(at >= 0, level.probability[np.maximum(at, 0)], level.left[state] * out[live])
        return out


def _grow(table: DataFrame, answers: list[DataFrame], tree: Tree) -> Tree:
    """The tree with the answers about its pairs and contexts, one length after the other."""
    for _ in range(DEPTH + 2):
        of = tree.positions()
        with _swept(table.sparkSession):
            found = C.replies(tree.chunks, lambda chunk: of(chunk).messages(), _answer, kind=Tokens).drop("tally")
            answers = [*answers, C.gathered_dealt(found, tree.n_parts)]
        tree = replace(tree, chunks=C.with_replies(table, *answers))
    return tree


def _score(of, ends: int):
    def run(batches):
        for row in C.rows_of(batches):
            own = of(Tokens(row))
            chunk, count = own.chunk, own.count
            logs = W.per_text(chunk, np.log10(count + 1.0)) + np.log10(ends + 1.0)
            known = W.per_text(chunk, count > 0) + int(ends > 0)
            score = np.bincount(own.text, weights=np.log10(own.probability()), minlength=len(chunk.ids))
            yield pa.RecordBatch.from_arrays(
                [pa.array(chunk.id_list(), pa.int64()), pa.array(chunk.marks), pa.array(chunk.counts + 1, pa.int64()), pa.array(known, pa.int64()), pa.array(logs), pa.array(score)],
                names=["doc_id", "trained", "n_tokens", "n_known", "logs", "score"])

    return run


def fit_and_score(docs: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, trained, n_tokens, n_known, train_tokens, base_score`` (the
    add-one unigram model's) and ``score`` for all documents; ``train`` marks
    the rows to learn from (an expression of ``doc_id``)."""
    with _swept(docs.sparkSession):
        table = saved(C.packed(docs, id_col, text_col, train).mapInArrow(lean(_tokenised, False), TOKENS))
        n = C.partitions_for(table)
        table = C.dealt(table, n)
    n_words, n_keys = C.buckets_for(table, KEY_BYTES), C.buckets_for(table, PAIR_BYTES)
    tokens, ends = _train_tokens(table)
    with _swept(docs.sparkSession):
        counted = saved(C.replies(table, _send_words(n_words), _answer_words, _tally_words, Tokens))
    tallies = [np.frombuffer(r["tally"], np.int64) for r in counted.where("tally is not null").select("tally").collect()]
    distinct, once, twice = (int(x) for x in sum(tallies, np.array([ends > 0, ends == 1, ends == 2], np.int64)))
    root = Root(tokens, distinct, once / (once + 2 * twice) if once else 0.5, ends)
    answers = [C.gathered_dealt(counted, n)]
    tree = Tree(root, C.with_replies(table, *answers), n_words, n_keys, n)
    tree = _grow(table, answers, tree) if tokens else tree
    scored = tree.chunks.mapInArrow(lean(_score(tree.positions(), ends), False), "doc_id long, trained boolean, n_tokens long, n_known long, logs double, score double")
    return scored.select("doc_id", "trained", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
                         (F.col("logs") - F.col("n_tokens") * float(np.log10(tokens + distinct + 1.0))).alias("base_score"), "score")
