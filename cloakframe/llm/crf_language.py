"""Language identification by a linear-chain conditional random field over words.

Every word gets a language, so code-switched texts are labelled piece by piece; a document's language is the one with
the largest mean probability over its words, and that mean is its score.

Features of a word (a run of letters or of anything outside ASCII, lower-cased, as UTF-8): its byte bigrams and trigrams
with the boundaries, its first and last three bytes, and how typical it is of each language in a lexicon counted from
the sample. Weights sit in hashed tables, so a batch of texts is scored with array look-ups. The weights and the
transitions are learned together, by the gradient that forward-backward gives, from sequences spliced of pieces of
different documents: a document's label holds for its words, and the splices show how languages follow each other.
Probabilities of words come from forward-backward over the whole text.

Every label is learned. The model is fitted on a bounded sample: about ``per_language`` documents of each label, chosen
by a hash, and of a long one a window of ``longest`` characters. Beyond ``MANY`` labels, documents, windows and hashed
tables shrink with their number, so that the sample and the model stay as large. Everything else covers all rows.

Results in odd cases: a null text or one without a letter gets ``und`` and the score 0; a null label is not learned;
without any label everything is ``und``; equal texts get equal results; no row is dropped; of ties the label that
sorts first wins; other columns stay beside the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"
PER_LANGUAGE, LONGEST = 300, 50_000
MANY, LEAST_DOCS, LEAST_CHARS = 32, 20, 2_000
TABLE, LEAST_TABLE = 18, 10  # bits of the hashed tables
SLICE = 1 << 21  # scores that are added up at once
CHUNK = 2_000_000  # bytes of text that are scored at once
STEPS, SEQUENCES, LENGTH, RATE = 150, 192, 40, 0.3
LONG, BLOCK = 4_096, 256  # words of a text from which on the recursion goes by blocks, and words of a block
ODD = 0x9E3779B97F4A7C15

WORD = np.zeros(256, bool)
WORD[ord("a") : ord("z") + 1] = WORD[128:] = True


class Words:
    """The words of some texts and the table rows that their features have."""

    def __init__(self, texts: list[str], bits: int = TABLE):
        self.bits = bits
        raw = [t.lower().encode("utf-8", "replace") for t in texts]
        data = np.frombuffer(b" " + b"  ".join(raw) + b"  ", np.uint8)
        inside = WORD[data]
        change = np.diff(inside.astype(np.int8))
        self.start, end = np.flatnonzero(change == 1) + 1, np.flatnonzero(change == -1) + 1
        begins = 1 + np.concatenate(([0], np.cumsum([len(r) + 2 for r in raw])))
        self.first = np.searchsorted(self.start, begins)  # of each text the number of its first word, and the end
        at = np.flatnonzero(inside)
        c = np.where(inside, data, 32).astype(np.uint32)
        pair = (c[at - 1] << 8) | c[at]
        self.pair = pair if bits >= 16 else self._slot(pair, 0)
        self.triple = self._slot((c[at - 1] << 16) | (c[at] << 8) | c[at + 1], 1)
        self.lengths = end - self.start
        self.offset = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        s, e, n = self.start, end, self.lengths
        second, third = np.where(n > 1, c[np.minimum(s + 1, e - 1)], 0), np.where(n > 2, c[np.minimum(s + 2, e - 1)], 0)
        self.prefix = self._slot((c[s] << 16) | (second << 8) | third, 2)
        second, third = np.where(n > 1, c[np.maximum(e - 2, s)], 0), np.where(n > 2, c[np.maximum(e - 3, s)], 0)
        self.suffix = self._slot((c[e - 1] << 16) | (second << 8) | third, 3)
        self.whole = self._whole(c, s, e)

    def _slot(self, value: np.ndarray, salt: int) -> np.ndarray:
        mixed = (value.astype(np.uint64) + np.uint64(salt << 32)) * np.uint64(ODD)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int32)

    def _whole(self, c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A slot per word from a polynomial of its bytes modulo 2**64, by differences of running sums."""
        base = 0x100000001B3
        power = np.full(len(c) + 1, base, np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        inverse = np.full(len(c) + 1, pow(base, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        np.cumprod(inverse, out=inverse)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((c + 1).astype(np.uint64) * power[:-1])))
        value = (sums[end] - sums[start]) * inverse[start]
        value ^= value >> np.uint64(29)
        return ((value * np.uint64(ODD)) >> np.uint64(64 - self.bits)).astype(np.int32)

    def __len__(self) -> int:
        return len(self.start)


class Model:
    """Tables of weights, one column per label."""

    def __init__(self, labels: list[str]):
        self.labels, k = labels, len(labels)
        self.bits = max(LEAST_TABLE, TABLE - (max(0, k - 1) // MANY).bit_length())
        self.pair = np.zeros((1 << min(16, self.bits), k), np.float32)
        self.triple, self.prefix, self.suffix, self.lexicon = (np.zeros((1 << self.bits, k), np.float32) for _ in range(4))
        self.trust = np.ones(k, np.float32)
        self.move = np.zeros((k, k), np.float32)

    def scores(self, words: Words) -> np.ndarray:
        out = np.zeros((len(words), len(self.labels)), np.float32)
        ends, step = np.append(words.offset, len(words.pair)), max(1, SLICE // len(self.labels))
        for a in range(0, len(words), step):
            b = min(a + step, len(words))
            grams = np.take(self.pair, words.pair[ends[a] : ends[b]], axis=0)
            grams += np.take(self.triple, words.triple[ends[a] : ends[b]], axis=0)
            out[a:b] = np.add.reduceat(grams, ends[a:b] - ends[a], axis=0)
        out += self.prefix[words.prefix]
        out += self.suffix[words.suffix]
        out += self.lexicon[words.whole] * self.trust
        return out


def _normal(x: np.ndarray) -> np.ndarray:
    x /= x.sum(axis=1, keepdims=True)
    return x


def marginals(scores: np.ndarray, first: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> Iterator[tuple]:
    """Forward-backward over sequences of words: sequence i has ``lengths[i]`` words from ``first[i]`` on, longest
    first. Yields, from the last step to the first, (numbers of the words, their probabilities, and the
    probabilities of the moves into them, or None at the first step). Each step is one array operation over all
    sequences that are that long."""
    k = scores.shape[1]
    local = np.exp(scores - scores.max(axis=1, keepdims=True)) + np.float32(1e-12)
    step = np.exp(move - move.max())
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left") if steps else np.zeros(0, int)
    ahead = np.empty_like(local)
    state = np.empty((len(lengths), k), np.float32)
    for t in range(steps):
        n = active[t]
        at = first[:n] + t
        state = _normal((state[:n] @ step if t else 1) * local[at])
        ahead[at] = state
    back = np.ones((len(lengths), k), np.float32)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        at = first[:n] + t
        held = ahead[at] * back[:n]
        total = held.sum(axis=1, keepdims=True)
        after = local[at] * back[:n]
        moved = None
        if t:
            moved = (ahead[at - 1], after, step)
        yield at, held / total, moved
        back[:n] = _normal(after @ step.T)


def blocked_marginals(scores: np.ndarray, first: np.ndarray, move: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The probabilities of all words of texts that start at the words ``first``: forward-backward as ``marginals`` does
    it, but over all texts as one sequence that is cut into blocks of equal length. Products of a block's moves come from
    steps over all blocks at once, then the messages between blocks, then the words inside; so one long text takes as
    many array operations as many short ones."""
    n, k = scores.shape
    block = max(1, min(block, n))
    rows = -(-n // block)
    local, fresh = np.ones((rows * block, k)), np.zeros(rows * block, bool)
    local[:n] = np.exp(scores - scores.max(axis=1, keepdims=True)) + 1e-12
    fresh[first[first < n]] = True
    fresh[n:] = True
    local, fresh = local.reshape(rows, block, k), fresh.reshape(rows, block)
    step = np.exp(move.astype(float) - float(move.max()))

    def moves(t: int) -> np.ndarray:
        return np.where(fresh[:, t, None, None], 1.0, step) * local[:, t, None, :]

    product = moves(0)
    for t in range(1, block):
        product = product @ moves(t)
        product /= product.max(axis=(1, 2), keepdims=True)
    enter, leave = np.ones((rows, k)), np.ones((rows, k))
    for r in range(1, rows):
        enter[r] = enter[r - 1] @ product[r - 1]
        enter[r] /= enter[r].sum()
        back = rows - r
        leave[back - 1] = product[back] @ leave[back]
        leave[back - 1] /= leave[back - 1].sum()
    ahead, state = np.empty((rows, block, k)), enter
    for t in range(block):
        state = (state[:, None] @ moves(t))[:, 0]
        state /= state.sum(axis=1, keepdims=True)
        ahead[:, t] = state
    state = leave
    for t in range(block - 1, -1, -1):
        ahead[:, t] *= state
        state = (moves(t) @ state[:, :, None])[:, :, 0]
        state /= state.sum(axis=1, keepdims=True)
    held = ahead.reshape(-1, k)[:n]
    return held / held.sum(axis=1, keepdims=True)


def fit(texts: list[str], names: list[str], seed: int = 7) -> Model:
    """Learns the weights from labelled texts."""
    labels = sorted(set(names))
    model, k = Model(labels), len(labels)
    words = Words(texts, model.bits)
    places = {name: j for j, name in enumerate(labels)}
    of = np.array([places[n] for n in names])
    sizes = np.diff(words.first)
    label_of_word = np.repeat(of, sizes)
    counts = np.stack([np.bincount(words.whole[label_of_word == j], minlength=1 << model.bits) for j in range(k)], axis=1)
    share = (counts + 0.1) / (counts.sum(axis=0) + 1)
    typical = np.log(share / share.mean(axis=1, keepdims=True))
    model.lexicon[:] = np.where(counts.sum(axis=1, keepdims=True) > 1, np.clip(typical, -4, 4), 0)
    usable = [np.flatnonzero((of == j) & (sizes > 0)) for j in range(k)]
    if k < 2 or not any(map(len, usable)):
        return model
    usable = [u for u in usable if len(u)]
    random = np.random.default_rng(seed)
    tables = ("pair", "triple", "prefix", "suffix", "trust", "move")
    seen = {t: np.full_like(getattr(model, t), 1e-2) for t in tables}
    for _ in range(STEPS):
        # Sequences of one to three pieces, each from a document of a language drawn evenly.
        picked = np.empty((SEQUENCES, LENGTH), np.int64)
        for i in range(SEQUENCES):
            cuts = np.sort(random.integers(1, LENGTH, random.integers(0, 3)))
            for a, b in zip((0, *cuts), (*cuts, LENGTH), strict=True):
                group = usable[random.integers(len(usable))]
                doc = group[random.integers(len(group))]
                start = random.integers(max(1, sizes[doc] - (b - a) + 1))
                picked[i, a:b] = words.first[doc] + (start + np.arange(b - a)) % sizes[doc]
        flat = picked.ravel()
        chosen = _Some(words, flat)
        gradient = np.empty((len(flat), k), np.float32)
        moves = np.zeros((k, k), np.float32)
        gold = label_of_word[flat]
        first = np.arange(SEQUENCES) * LENGTH
        scores = model.scores(chosen)
        for at, held, moved in marginals(scores, first, np.full(SEQUENCES, LENGTH), model.move):
            gradient[at] = -held
            gradient[at, gold[at]] += 1
            if moved:
                before, after, step = moved
                whole = ((before @ step) * after).sum(axis=1, keepdims=True)
                moves -= step * ((before / whole).T @ after)
                np.add.at(moves, (gold[at - 1], gold[at]), 1)
        per_gram = np.repeat(gradient, chosen.lengths, axis=0)
        changes = {
            "pair": _summed(chosen.pair, per_gram, len(model.pair)), "triple": _summed(chosen.triple, per_gram, 1 << model.bits),
            "prefix": _summed(chosen.prefix, gradient, 1 << model.bits), "suffix": _summed(chosen.suffix, gradient, 1 << model.bits),
            "trust": (gradient * model.lexicon[chosen.whole]).sum(axis=0), "move": moves,
        }
        for name, change in changes.items():
            change /= SEQUENCES
            seen[name] += change * change
            getattr(model, name)[...] += RATE * change / np.sqrt(seen[name])
    return model


def _summed(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    return np.stack([np.bincount(rows, values[:, j], size) for j in range(values.shape[1])], axis=1).astype(np.float32)


class _Some(Words):
    """Chosen words of others, in a new order."""

    def __init__(self, words: Words, chosen: np.ndarray):
        self.start = words.start[chosen]
        self.lengths = words.lengths[chosen]
        self.prefix, self.suffix, self.whole = (x[chosen] for x in (words.prefix, words.suffix, words.whole))
        self.offset = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        within = np.arange(int(self.lengths.sum())) - np.repeat(self.offset, self.lengths)
        grams = np.repeat(words.offset[chosen], self.lengths) + within
        self.pair, self.triple = words.pair[grams], words.triple[grams]


def label(model: Model, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The language and the score of each text."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    known = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))] if model.labels else []
    known.sort(key=lambda i: -len(texts[i]))  # texts of like length meet, which saves steps
    chunk = CHUNK * MANY // max(MANY, len(model.labels))
    while known:
        size, n = 0, 0
        while n < len(known) and (not n or size + len(texts[known[n]]) <= chunk):
            size += len(texts[known[n]])
            n += 1
        some, known = known[:n], known[n:]
        words = Words([texts[i] for i in some], model.bits)
        lengths = np.diff(words.first)
        order = np.argsort(-lengths, kind="stable")
        sums = np.zeros((len(some), len(model.labels)))
        first = words.first[:-1][order]
        if lengths.max(initial=0) > LONG:
            # Rows of scores are in the order of the texts, so sums over them are differences of running sums.
            held = blocked_marginals(model.scores(words), words.first[:-1], model.move)
            running = np.concatenate((np.zeros((1, held.shape[1])), np.cumsum(held, axis=0)))
            sums[:] = (running[words.first[1:]] - running[words.first[:-1]])[order]
        else:
            for _, held, _ in marginals(model.scores(words), first, lengths[order], model.move):
                sums[: len(held)] += held
        means = sums / np.maximum(lengths[order], 1)[:, None]
        for row, mean in zip(order.tolist(), means, strict=True):
            if lengths[row]:
                best = int(mean.argmax())
                names[some[row]], scores[some[row]] = model.labels[best], min(1.0, float(mean[best]))
    return names, scores


def word_labels(model: Model, text: str | None) -> list[tuple[int, int, str, float]]:
    """(start, end, language, probability) of each word of a text, in code points of the text."""
    words = Words([text or ""], model.bits) if model.labels else None
    if words is None or not len(words):
        return []
    held = blocked_marginals(model.scores(words), words.first[:-1], model.move)
    # Words are runs of bytes of the lower-cased text, whose places are told by counting its code points; lower case
    # may be longer than what it comes from.
    lower = [c.lower() for c in text]
    sizes = np.fromiter((len(c.encode("utf-8", "replace")) for c in lower), np.int64, len(lower))
    ends = np.cumsum(sizes)
    starts = np.searchsorted(ends, words.start - 1, side="right")
    stops = np.searchsorted(ends, words.start - 1 + words.lengths - 1, side="right") + 1
    best = held.argmax(axis=1)
    return [
        (int(a), int(b), model.labels[j], float(p))
        for a, b, j, p in zip(starts, stops, best, held[np.arange(len(best)), best], strict=True)
    ]


def label_words(docs: DataFrame, model: Model, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word of each text: the key, start and end (code points, end exclusive), word, lang and probability.
    Texts without words, or a model without labels, give no rows."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<struct<start:int,end:int,lang:string,probability:double>>")
    def of(texts: pd.Series) -> pd.Series:
        names = ("start", "end", "lang", "probability")
        return pd.Series([[dict(zip(names, w, strict=True)) for w in word_labels(shipped.value, t if isinstance(t, str) else None)] for t in texts])

    rows = docs.select(F.col(key_col).alias("key"), F.col(text_col).alias("text"), F.explode(of(F.col(text_col))).alias("w"))
    word = F.substring("text", F.col("w.start") + 1, F.col("w.end") - F.col("w.start"))
    return rows.select(F.col("key").alias(key_col), "w.start", "w.end", word.alias("word"), "w.lang", "w.probability")


def learn(
    docs: DataFrame,
    label_col: str = "lang",
    text_col: str = "text",
    key_col: str = "doc_id",
    per_language: int = PER_LANGUAGE,
    longest: int = LONGEST,
) -> Model:
    """A model fitted on the sample; ``docs`` holds only what may be learned from."""
    usable = docs.select(F.col(label_col).alias("label"), F.col(text_col).alias("text"), F.col(key_col).cast("string").alias("key"))
    usable = usable.where("label IS NOT NULL AND text IS NOT NULL")
    counts = usable.groupBy("label").agg(F.count("*").alias("n"))
    labels = counts.count()
    if not labels:
        return Model([])
    if labels > MANY:
        per_language = max(min(LEAST_DOCS, per_language), per_language * MANY // labels)
        longest = max(min(LEAST_CHARS, longest), longest * MANY // labels)
    draw = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    drawn = usable.withColumn("draw", draw).join(F.broadcast(counts), "label").where(F.col("draw") * F.col("n") < per_language)
    spare = F.greatest(F.length("text") - longest, F.lit(0)) + 1
    part = F.substring("text", F.pmod(F.xxhash64("key", F.lit("window")), spare).cast("int") + 1, F.lit(longest))
    rank = F.row_number().over(Window.partitionBy("label").orderBy("draw", "key"))
    some = drawn.select("label", "draw", "key", part.alias("part")).withColumn("rank", rank).where(F.col("rank") <= 2 * per_language)
    chosen = some.select("label", "part").collect()
    chosen.sort(key=lambda r: (r[0], r[1]))
    return fit([r[1] for r in chosen], [r[0] for r in chosen]) if chosen else Model([])


def predict(docs: DataFrame, model: Model, text_col: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The rows with the language and the score of their whole text."""
    clash = {c.lower() for c in docs.columns} & set(names)
    if clash:
        raise ValueError(f"input columns would be hidden: {sorted(clash)}")
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        found, scores = label(shipped.value, [t if isinstance(t, str) else None for t in texts])
        return pd.DataFrame({"lang": found, "score": scores})

    packed = docs.select(F.struct("*").alias("row"), of(F.col(text_col)).alias("p"))
    return packed.select("row.*", F.col("p.lang").alias(names[0]), F.col("p.score").alias(names[1]))


def held_out(key: Column) -> Column:
    """Whether a document is never learned from: the checksum of its id, as text, is 1 modulo 3."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def identify(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """All rows with held_out, lang_pred and score; rows without an id are not learned from either."""
    learned = docs.where(F.col(key_col).isNotNull() & ~held_out(F.col(key_col))).select(key_col, text_col, label_col)
    model = learn(learned, label_col, text_col, key_col)
    return predict(docs.withColumn("held_out", held_out(F.col(key_col))), model, text_col)


def keep_identified(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """The documents with a language, that is all but ``und``, with all their columns: the share of one language says
    nothing against a text in several, or in one that was not learned. Without any label to learn from, no document can
    be judged and all stay."""
    learned = docs.where(F.col(key_col).isNotNull() & ~held_out(F.col(key_col))).select(key_col, text_col, label_col)
    model = learn(learned, label_col, text_col, key_col)
    if not model.labels:
        return docs
    packed = docs.select(F.struct("*").alias("row"), F.col(text_col).alias("text"))
    return predict(packed, model).where(F.col("lang_pred") != UNKNOWN).select("row.*")
