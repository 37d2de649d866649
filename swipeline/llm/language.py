"""Language of texts by a linear-chain conditional random field over words.

Every word with a letter is a position; affixes, byte n-grams and lexicon membership give its scores
and a learned matrix the transitions. Forward-backward labels each word, so code-switched text is
not forced into one language, and a text's language is the one with most posterior mass.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swipeline.llm.common import batches_of

UNKNOWN = "und"
_BITS = 16


@dataclass
class Model:
    """Labels in order, weights of hashed features, transition weights, and the lexicon of words."""

    labels: list[str]
    weights: np.ndarray
    transitions: np.ndarray
    lexicon: dict[bytes, int]


class Words:
    """Scores of the words that a task has met; beyond ``room`` it starts anew, so its size is bounded."""

    def __init__(self, model: Model, room: int = 150_000):
        self.model, self.room = model, room
        self.row: dict[str, int] = {}
        self.parts: list[np.ndarray] = []
        self.rows = 0

    def learn(self, words: set[str]) -> None:
        if len(self.row) > self.room:
            self.row, self.parts, self.rows = {}, [], 0
        new = list(words.difference(self.row))
        # A word has some forty features of several numbers each, so few words are held so at once.
        for at in range(0, len(new), 4_000):
            some = new[at : at + 4_000]
            cores = [core_of(w) for w in some]
            lettered = [c for c in cores if c]
            flat, owner = _flat(lettered, self.model.lexicon)
            self.parts.append(_scores(self.model.weights, flat, owner, len(lettered)))
            for word, core in zip(some, cores, strict=True):
                self.row[word] = self.rows if core else -1
                self.rows += bool(core)

    def table(self) -> np.ndarray:
        self.parts = [np.concatenate(self.parts)] if self.parts else [np.zeros((0, len(self.model.labels)))]
        return self.parts[0]


def core_of(word: str) -> bytes:
    """The lower-cased word without what is no letter at its ends; empty if it has no letter."""
    if word.isalpha():
        return word.lower().encode("utf-8", "replace")
    at = [i for i, c in enumerate(word) if c.isalpha()]
    return word[at[0] : at[-1] + 1].lower().encode("utf-8", "replace") if at else b""


def features_of(core: bytes, lexicon: dict[bytes, int]) -> list[int]:
    """Hashed features: affixes of one to four bytes, n-grams of two to four, lexicon membership."""
    crc, framed = zlib.crc32, b"^" + core + b"$"
    out = [crc(core[:n], 11) for n in (1, 2, 3, 4)] + [crc(core[-n:], 13) for n in (1, 2, 3, 4)]
    for n in (2, 3, 4):
        out += [crc(framed[i : i + n], n) for i in range(len(framed) - n + 1)]
    if core in lexicon:
        out.append(crc(b"%d" % lexicon[core], 17))
    return out


def _step(register: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return _table()[(register ^ byte) & np.uint32(255)] ^ (register >> np.uint32(8))


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    """CRC-32 of each byte, as the register has it."""
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> np.uint32(1)) ^ np.uint32(0xEDB88320), byte >> np.uint32(1))
    return byte


def _flat(cores: list[bytes], lexicon: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all words, those of `features_of`, and the word that each belongs to.

    All words lie in one array, so a feature is a few steps of the CRC over whole arrays.
    """
    if not cores:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    data = np.frombuffer(b"".join([b"^" + c + b"$" for c in cores]), np.uint8).astype(np.uint32)
    size, word, ones = np.array([len(c) for c in cores]), np.arange(len(cores)), np.uint32(0xFFFFFFFF)
    first = np.cumsum(size + 2) - size - 1
    flat, owner = [], []

    def add(register: np.ndarray, whose: np.ndarray) -> None:
        flat.append(register ^ ones)
        owner.append(whose)

    # Affixes of a word shorter than asked for are the word itself.
    for seed, at_end in ((11, False), (13, True)):
        for n in (1, 2, 3, 4):
            many = np.minimum(n, size)
            start = first + size - many if at_end else first
            register = np.full(len(cores), np.uint32(seed) ^ ones)
            for k in range(n):
                live = np.flatnonzero(k < many)
                register[live] = _step(register[live], data[start[live] + k])
            add(register, word)
    whose = np.repeat(word, size + 2)
    room = np.repeat(first + size, size + 2) - np.arange(len(data))  # bytes after this one
    for n in (2, 3, 4):
        at = np.flatnonzero(room >= n - 1)
        register = np.full(len(at), np.uint32(n) ^ ones)
        for k in range(n):
            register = _step(register, data[at + k])
        add(register, whose[at])
    label = np.array([lexicon.get(c, -1) for c in cores])
    known = np.flatnonzero(label >= 0)
    names = np.array([zlib.crc32(b"%d" % k, 17) for k in range(label.max(initial=-1) + 1)], np.uint32)
    add(names[label[known]] ^ ones, known)
    numbers = np.concatenate(flat).astype(np.int64)
    return (numbers ^ numbers >> _BITS) & ((1 << _BITS) - 1), np.concatenate(owner)


def _scores(weights: np.ndarray, flat: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Scores of each word: the mean of its features' weights times four, so long words stay in range."""
    count = np.maximum(np.bincount(owner, minlength=n), 1)
    total = np.stack([np.bincount(owner, weights[flat, k], n) for k in range(weights.shape[1])], axis=1)
    return total * 4 / count[:, None]


def posteriors(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray, pairs: bool = False):
    """Forward-backward over sequences laid out by position.

    ``lengths`` descend; ``scores`` holds position 0 of all sequences, then position 1 of those that
    have one, and so on. Returns the posteriors in that layout, and with ``pairs`` also the expected
    transitions and the log-likelihood's normaliser.
    """
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    starts = np.concatenate([[0], np.cumsum(active)])
    shift = scores.max(axis=1, keepdims=True)
    emit, move = np.exp(scores - shift), np.exp(transitions)
    forward, scale = np.empty_like(emit), np.empty(len(emit))
    for t in range(steps):
        a, k = starts[t], active[t]
        now = emit[a : a + k] if t == 0 else (forward[starts[t - 1] : starts[t - 1] + k] @ move) * emit[a : a + k]
        total = now.sum(axis=1)
        scale[a : a + k] = total
        np.divide(now, total[:, None], out=forward[a : a + k])
    out, expected = np.empty_like(emit), np.zeros_like(transitions)
    back = np.empty((0, scores.shape[1]))
    for t in range(steps - 1, -1, -1):
        a, k = starts[t], active[t]
        if t == steps - 1:
            back = np.ones((k, scores.shape[1]))
        else:
            n = active[t + 1]
            after = back * emit[starts[t + 1] : starts[t + 1] + n]
            after /= scale[starts[t + 1] : starts[t + 1] + n, None]
            if pairs:
                expected += forward[a : a + n].T @ after
            back = np.ones((k, scores.shape[1]))
            back[:n] = after @ move.T
        out[a : a + k] = forward[a : a + k] * back
    out /= out.sum(axis=1, keepdims=True)
    if pairs:
        return out, expected * move, float(np.log(scale).sum() + shift.sum())
    return out


def _positions(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For descending lengths: where each word of the concatenated texts goes in the layout by position."""
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    starts = np.concatenate([[0], np.cumsum(active)])[:steps]
    doc = np.repeat(np.arange(len(lengths)), lengths)
    at = np.arange(len(doc)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return starts[at] + doc, doc


def train(texts: list[str], langs: list[str], words: int = 96, rounds: int = 30, seed: int = 7) -> Model:
    """Fit on labelled snippets. Sequences are put together from runs of words of one to four
    snippets, so the transitions also learn how rarely languages change."""
    labels = sorted(set(langs))
    rng = np.random.default_rng(seed)
    runs = []
    for text, lang in zip(texts, langs, strict=True):
        cores = [c for c in map(core_of, text.split()) if c]
        runs += [(cores[i : i + words // 4], labels.index(lang)) for i in range(0, len(cores), words // 4)]
    if not runs:
        return Model(labels, np.zeros((1 << _BITS, max(1, len(labels)))), np.zeros((max(1, len(labels)),) * 2), {})
    by_label = [[i for i, (_, y) in enumerate(runs) if y == k] for k in range(len(labels))]
    sequences, i = [], 0
    order = rng.permutation(len(runs))
    while i < len(order):
        held = [int(order[i])]
        # Three times in four the next run is of the same language.
        for _ in range(3):
            same = by_label[runs[held[-1]][1]]
            held.append(int(same[rng.integers(len(same))]) if rng.random() < 0.75 else int(order[rng.integers(len(order))]))
        sequences.append(held)
        i += 2
    seen: dict[int, Counter] = {k: Counter() for k in range(len(labels))}
    for cores, y in runs:
        seen[y].update(cores)
    total = sum(seen.values(), Counter())
    lexicon = {w: k for k in seen for w, n in seen[k].items() if n >= 3 and n >= 0.9 * total[w]}
    number: dict[bytes, int] = {}
    tokens = [[(number.setdefault(c, len(number)), runs[r][1]) for r in s for c in runs[r][0]] for s in sequences]
    tokens.sort(key=len, reverse=True)
    lengths = np.array([len(t) for t in tokens])
    at, _ = _positions(lengths)
    word, gold = np.empty(len(at), np.int64), np.empty(len(at), np.int64)
    word[at] = [w for t in tokens for w, _ in t]
    gold[at] = [y for t in tokens for _, y in t]
    n, k = len(number), len(labels)
    flat, owner = _flat(list(number), lexicon)
    share = 4 / np.maximum(np.bincount(owner, minlength=n), 1)[owner]
    observed = np.zeros((k, k))
    for t in tokens:
        y = np.array([y for _, y in t])
        np.add.at(observed, (y[:-1], y[1:]), 1)
    weights, moves = np.zeros((1 << _BITS, k)), np.zeros((k, k))
    sum_w, sum_m = np.full_like(weights, 1e-8), np.full_like(moves, 1e-8)
    truth = np.eye(k)[gold]
    for _ in range(rounds):
        scores = _scores(weights, flat, owner, n)
        post, expected, _ = posteriors(scores[word], lengths, moves, pairs=True)
        rest = truth - post
        slope = np.stack([np.bincount(word, rest[:, j], n) for j in range(k)], axis=1)
        for j in range(k):
            g = np.bincount(flat, slope[owner, j] * share, 1 << _BITS) / len(word) - 1e-6 * weights[:, j]
            sum_w[:, j] += g * g
            weights[:, j] += 0.5 * g / np.sqrt(sum_w[:, j])
        g = (observed - expected) / len(word) - 1e-6 * moves
        sum_m += g * g
        moves += 0.3 * g / np.sqrt(sum_m)
    return Model(labels, weights.astype(np.float32), moves, lexicon)


def predict(model: Model, texts: list[str | None], words: Words | None = None) -> tuple[list[str], np.ndarray]:
    """Language and score of whole texts; the score is the mean posterior of that language."""
    if not model.labels:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    words = words or Words(model)
    split = [(t or "").split() for t in texts]
    words.learn(set().union(*split))
    table, find = words.table(), words.row.__getitem__
    rows = [np.fromiter(map(find, held), np.int64, len(held)) for held in split]
    rows = [r[r >= 0] for r in rows]
    n = np.array([len(r) for r in rows])
    order = np.argsort(-n, kind="stable")
    order = order[n[order] > 0]
    best, score = np.full(len(texts), -1), np.zeros(len(texts))
    first = 0
    while first < len(order):
        last = first + max(1, int(np.searchsorted(np.cumsum(n[order[first:]]), 100_000)))
        group = order[first:last]
        at, doc = _positions(n[group])
        held = np.empty(len(at), np.int64)
        held[at] = np.concatenate([rows[i] for i in group])
        post = posteriors(table[held], n[group], model.transitions)[at]
        mass = np.stack([np.bincount(doc, post[:, j], len(group)) for j in range(post.shape[1])], axis=1)
        mass /= n[group][:, None]
        best[group] = mass.argmax(axis=1)
        score[group] = np.clip(mass.max(axis=1), 0, 1)
        first = last
    return [model.labels[b] if b >= 0 else UNKNOWN for b in best], score


def fit(docs: DataFrame, per_language: int = 250, snippet: int = 1200, seed: int = 7) -> Model:
    """Learn from a bounded sample: at most ``per_language`` snippets of ``snippet`` characters.

    Rows with crc32(doc_id) mod 4 = 2 are never learned from. Snippets start at a place that depends
    on the doc_id's hash. Only the number of rows per language and the snippets come to the driver.
    """
    usable = docs.where("lang is not null and text is not null and doc_id is not null").where(~_held_out())
    counts = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    if not counts:
        return train([], [])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30))
    rate = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, 2 * per_language / n)))])
    offset = F.floor(F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - snippet, F.lit(1)))).cast("int") + 1
    rows = (
        usable.where(draw < rate[F.col("lang")] * (1 << 30))
        .select("lang", "doc_id", F.substring("text", offset, F.lit(snippet)).alias("part"), draw.alias("draw"))
        .orderBy("draw", "doc_id", "part")
        .limit(4 * per_language * len(counts))
        .collect()
    )
    held: Counter = Counter()
    some = []
    for r in rows:
        held[r["lang"]] += 1
        if held[r["lang"]] <= per_language:
            some.append((r["part"], r["lang"]))
    return train([t for t, _ in some], [y for _, y in some], seed=seed)


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row's whole text.

    Predictions see the text alone. ``und`` with score 0 for a null text or one without a letter, or
    if nothing was learned. Words without letters are passed over; equal masses go to the first
    label. A null doc_id is not held out. Repeated rows are predicted each; an empty table gives no
    rows; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(shared.value)
        for whole in batches:
            for batch in batches_of(whole, "text", 2 << 20):
                lang, score = predict(shared.value, batch.column("text").to_pylist(), words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score)],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )
            pa.default_memory_pool().release_unused()

    columns = docs.select("doc_id", _held_out().alias("held_out"), "text")
    return columns.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def reject_unknown(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language.

    Rejects null texts and texts without a letter, nothing else: texts even between languages stay,
    and if no language was learned, every text with a letter does. Repeated rows are judged alike, long
    texts as a whole; empty tables stay empty; further columns pass.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(shared.value)
        for whole in batches:
            for batch in batches_of(whole, "text", 2 << 20):
                texts = batch.column("text").to_pylist()
                if shared.value.labels:
                    keep = [x != UNKNOWN for x in predict(shared.value, texts, words)[0]]
                else:
                    keep = [any(map(str.isalpha, t or "")) for t in texts]
                yield batch.filter(pa.array(keep, pa.bool_()))
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, docs.schema)
