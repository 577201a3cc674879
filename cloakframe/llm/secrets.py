"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that finds further ones.

The patterns give the base spans. The field tags every token (a run of ASCII letters, digits, underscores and anything
outside ASCII, or one other sign) as begin, inside or outside of a secret. Features of a token: its shape (kinds of
characters, length, changes between kinds, different characters), the words around it, the gaps beside it, and what kind
of file it stands in (digits, signs, line lengths). Tags come from Viterbi over the whole text; a run of begin and
inside without white space is a span. A span that lies inside a base span says nothing new and is left out, as is one of fewer than
``SHORTEST`` code points.

Viterbi runs over all texts of a batch at once, as products of small max-plus matrices in blocks: a long text takes as
many array operations as many short ones.

The field is trained on a bounded sample, at most ``PER_KIND`` windows around base spans and as many from anywhere,
chosen by a hash; base spans are looked for in ``POOL`` times as many texts. The labels are what the patterns found, less runs of digits only, which are numbers of other kinds
more often than keys. Copies of each window with the secret redrawn from other alphabets, with and without the words
before it, teach the field what the patterns do not say; windows without a secret come again with addresses, paths,
numbers, dates and names strewn in. Everything else covers all rows and whole texts.

Results in odd cases: a null or empty text has no spans; equal texts have equal spans; no row is dropped; rows with a
null id are scanned as any other; without any base span in the sample the field adds nothing; a column of the input
whose name is that of a result raises; other columns stay.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cloakframe.llm.common import stored
from cloakframe.llm.files import kept

KINDS = ("assign", "access", "hex", "crf")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
# The patterns of base spans.
ASSIGN = re.compile(
    r"((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]{14,}"), re.compile("[0-9a-f]{16,}")
HINT = r"[0-9a-f]{16}|AKIA[A-Z0-9]{14}|(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"

SHORTEST = 8
PER_KIND, POOL, WINDOW, LENGTH = 1_500, 1_000, 600, 64  # windows of each kind, texts to look in for each, code points and tokens
STEPS, BATCH, RATE, COPIES = 160, 192, 0.25, 2
CHUNK, BLOCK = 2_000_000, 256  # code points that are tagged at once; steps of a block
BITS = 16
B, I, O = range(3)
ODD = np.uint64(0x9E3779B97F4A7C15)
RESULT = "base string, spans string, n_assign long, n_access long, n_hex long, n_crf long"

NONE, LOWER, UPPER, DIGIT, LINE, SIGN, WIDE = range(7)
KIND = np.full(129, SIGN, np.uint8)
KIND[:33] = KIND[127] = NONE
KIND[ord("a") : ord("z") + 1], KIND[ord("A") : ord("Z") + 1], KIND[ord("0") : ord("9") + 1] = LOWER, UPPER, DIGIT
KIND[ord("_")], KIND[128] = LINE, WIDE
# What a token is made of: a bit per kind it has, and one each for "not only 0-9a-f" and "not only 0-9A-F".
MADE = np.where(KIND > 0, 1 << (KIND.astype(int) - 1), 0)
_HEX = np.isin(np.arange(129), np.frombuffer(b"0123456789abcdef", np.uint8))
_CAPITAL = np.isin(np.arange(129), np.frombuffer(b"0123456789ABCDEF", np.uint8))
MADE = (MADE | ~_HEX * 64 | ~_CAPITAL * 128).astype(np.uint8)
LENGTHS = np.array([2, 3, 4, 5, 6, 7, 8, 10, 13, 16, 18, 24, 32, 40, 48])
GROUPS = {
    "shape": 1 << 12, "mixed": 1 << 12, "self": 1 << BITS, "before": 1 << BITS, "second": 1 << BITS, "third": 1 << BITS,
    "after": 1 << BITS, "pair": 1 << BITS, "left": 1 << 12, "right": 1 << 12, "gaps": 9 << 8, "file": 64 << 8,
}


MARK = np.left_shift(np.uint64(1), np.arange(64, dtype=np.uint64))


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd number modulo 2**64, and their inverses; remembered between batches."""
    held = kept()
    if len(held.get("powers", [[]])[0]) < n:
        held["powers"] = []
        for base in (int(ODD), pow(int(ODD), -1, 1 << 64)):
            power = np.full(1 << n.bit_length(), base, np.uint64)
            power[0] = 1
            held["powers"].append(np.cumprod(power))
    return [p[:n] for p in held["powers"]]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, number of the kind) of the pattern spans, by start, then kind."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(text)]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], s[2]))


def values(text: str) -> list[tuple[int, int]]:
    """What the field learns as secrets: values of assignments and keys, merged where they overlap."""
    found = []
    for start, end, kind in base_spans(text):
        if kind == 0:
            start = ASSIGN.match(text, start).start(2)
        if kind == 2 and not re.search("[a-f]", text[start:end]):
            continue
        if found and start < found[-1][1]:
            found[-1] = (found[-1][0], max(end, found[-1][1]))
        else:
            found.append((start, end))
    return found


class Tokens:
    """The tokens of some texts and the table rows of their features."""

    def __init__(self, texts: list[str], files: list[int] | None = None):
        code = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), "<u4")
        kind = KIND[np.minimum(code, 128)]
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        begins = np.concatenate(([0], np.cumsum(sizes)))
        word = (kind != NONE) & (kind != SIGN)
        starts = word.copy()
        starts[1:] &= ~word[:-1]
        starts |= kind == SIGN
        self.start = np.flatnonzero(starts)
        edges = np.flatnonzero(starts | (kind == NONE))
        self.end = edges[1:][starts[edges[:-1]]]  # the last code point is white space
        self.first = np.searchsorted(self.start, begins)  # of each text its first token, and the end
        self.begins = begins
        self._code, self._kind, self._short = code, kind, np.minimum(code, 128)
        self.files = self._file_kinds(texts) if files is None else np.array(files, np.int64)

    def __len__(self) -> int:
        return len(self.start)

    def _file_kinds(self, texts: list[str]) -> np.ndarray:
        def share(flags: np.ndarray, limits: list[float]) -> np.ndarray:
            return np.digitize(np.add.reduceat(flags, self.begins[:-1], dtype=np.int64) / np.diff(self.begins), limits)

        digits = share(self._kind == DIGIT, [0.01, 0.05, 0.2])
        signs = share(self._kind == SIGN, [0.03, 0.08, 0.2])
        lines = share(self._code == 10, [0.002, 0.01, 0.03])
        return digits * 16 + signs * 4 + lines

    def features(self) -> Iterator[tuple[str, np.ndarray]]:
        """(group of features, row per token)"""
        if not len(self):
            return
        code, kind, start, end = self._code, self._kind, self.start, self.end
        length = end - start
        size = np.digitize(length, LENGTHS)
        spans = np.stack((start, end), axis=1).ravel()  # white space ends the last token, so all are places
        made_of = np.bitwise_or.reduceat(MADE[self._short], spans)[::2].astype(np.int64) ^ 0xC0
        shape = made_of * 16 + size
        yield "shape", shape

        changed = np.zeros(len(code) + 1, np.int32)
        np.cumsum(kind[1:] != kind[:-1], out=changed[1:-1])
        changes = np.minimum(changed[end - 1] - changed[start], 15)
        different = np.bitwise_count(np.bitwise_or.reduceat(MARK[code & 63], spans)[::2]).astype(np.int64)
        yield "mixed", (changes * 16 + np.minimum(different, 31) // 2) * 16 + size

        low = code + (kind == UPPER) * np.uint32(32)
        power, inverse = _powers(len(code))
        sums = np.zeros(len(code) + 1, np.uint64)
        np.cumsum((low + np.uint32(1)) * power, out=sums[1:])
        hashed = (sums[end] - sums[start]) * inverse[start]
        name = ((hashed ^ (hashed >> np.uint64(31))) * ODD >> np.uint64(64 - BITS)).astype(np.int64)
        name = np.where((made_of & (1 << (DIGIT - 1)) > 0) | (length > 16), 2 + size, np.maximum(name, 32))
        yield "self", name
        text_of = np.repeat(np.arange(len(self.files)), np.diff(self.first))

        def neighbour(values: np.ndarray, by: int, edge: int) -> np.ndarray:
            out = np.full(len(values), edge, np.int64)
            at = np.arange(max(0, -by), len(values) - max(0, by))
            same = text_of[at] == text_of[at + by]
            out[at[same]] = values[at[same] + by]
            return out

        before, second = neighbour(name, -1, 1), neighbour(name, -2, 1)
        yield "before", before
        yield "second", second
        yield "third", neighbour(name, -3, 1)
        yield "after", neighbour(name, 1, 1)
        yield "pair", ((before * 31 + second).astype(np.uint64) * ODD >> np.uint64(64 - BITS)).astype(np.int64)
        yield "left", neighbour(shape, -1, 0)
        yield "right", neighbour(shape, 1, 0)
        left, right = code[start - 1], code[end]  # before the first stands the last, which is a line end
        gaps = [np.where(c == 10, 2, KIND[np.minimum(c, 128)] == NONE) for c in (left, right)]
        yield "gaps", (gaps[0] * 3 + gaps[1]) * 256 + made_of
        yield "file", self.files[text_of] * 256 + made_of


class Model:
    """Tables of weights with a column per tag, and the moves between tags."""

    def __init__(self):
        self.tables = {name: np.zeros((size, 3), np.float32) for name, size in GROUPS.items()}
        self.move = np.zeros((4, 3), np.float32)  # the last row is the start
        self.trained = False

    def scores(self, tokens: Tokens) -> np.ndarray:
        out = np.zeros((len(tokens), 3), np.float32)
        for name, rows in tokens.features():
            out += self.tables[name][rows]
        return out


def viterbi(scores: np.ndarray, first: np.ndarray, move: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The best tags of all tokens; texts start at the token numbers ``first``.

    All tokens are one sequence in which the first token of a text does not depend on the tag before it. It is cut into
    blocks of equal length; each step works on all blocks at once, first for the products of each block, then, with the
    state at which each block is entered, for the best tags before each, and back again.
    """
    n = len(scores)
    if not n:
        return np.zeros(0, np.int8)
    block = max(1, min(block, n))
    rows = -(-n // block)
    local = np.zeros((rows * block, 3))
    local[:n] = scores
    fresh = np.zeros(rows * block, bool)
    fresh[first[first < n]] = True
    fresh[n:] = True  # what fills the last block says nothing about the text before
    local = np.ascontiguousarray(local.reshape(rows, block, 3).transpose(1, 2, 0))
    fresh = np.ascontiguousarray(fresh.reshape(rows, block).T)
    step, start = move[:3].astype(float), move[3].astype(float)

    def moves(t: int) -> np.ndarray:
        """From each tag to each tag, in each block."""
        return np.where(fresh[t], start[None, :, None], step[:, :, None]) + local[t]

    product = moves(0)
    for t in range(1, block):
        product = (product[:, :, None] + moves(t)[None]).max(axis=1)
    enter = np.zeros((3, rows))
    for r in range(1, rows):
        entered = (enter[:, r - 1, None] + product[:, :, r - 1]).max(axis=0)
        enter[:, r] = entered - entered.max()
    came = np.empty((block, 3, rows), np.int8)
    state = enter
    for t in range(block):
        ways = state[:, None] + moves(t)
        came[t] = ways.argmax(axis=0)
        state = ways.max(axis=0)
    # From the tag at a block's end to the tag before its start, for all three, then for the one that holds.
    back, all_rows = np.tile(np.arange(3)[:, None], (1, rows)), np.arange(rows)
    for t in range(block - 1, -1, -1):
        back = came[t][back, all_rows]
    last = np.empty(rows, np.int64)
    last[-1] = state[:, -1].argmax()
    for r in range(rows - 1, 0, -1):
        last[r - 1] = back[last[r], r]
    tags = np.empty((rows, block), np.int8)
    for t in range(block - 1, -1, -1):
        tags[:, t] = last
        last = came[t][last, all_rows]
    return tags.ravel()[:n]


def tagged_spans(model: Model, texts: list[str]) -> list[list[tuple[int, int]]]:
    """The spans of each text that the field tags as secrets."""
    found: list[list[tuple[int, int]]] = [[] for _ in texts]
    if not model.trained:
        return found
    tokens = Tokens(texts)
    tags = viterbi(model.scores(tokens), tokens.first[:-1], model.move)
    hits = np.flatnonzero(tags != O)
    text_of = np.searchsorted(tokens.first, hits, side="right") - 1
    for i, d in zip(hits.tolist(), text_of.tolist(), strict=True):
        base = int(tokens.begins[d])
        start, end = int(tokens.start[i]) - base, int(tokens.end[i]) - base
        if tags[i] == I and found[d] and found[d][-1][1] == start:
            found[d][-1] = (found[d][-1][0], end)
        else:
            found[d].append((start, end))
    return found


def scan(model: Model, texts: list[str], shortest: int = SHORTEST) -> list[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """(base spans, all spans) of each text."""
    out = []
    for text, tagged in zip(texts, tagged_spans(model, texts), strict=True):
        base = base_spans(text)
        added, i, reach = [], 0, 0
        for start, end in tagged:  # both lists rise
            while i < len(base) and base[i][0] <= start:
                reach = max(reach, base[i][1])
                i += 1
            if end > reach and end - start >= shortest:
                added.append((start, end, 3))
        out.append((base, sorted(base + added, key=lambda s: (s[0], s[2])) if added else base))
    return out


def _redrawn(text: str, spans: list[tuple[int, int]], chance: random.Random) -> tuple[str, list[tuple[int, int]]]:
    """The text with its secrets drawn anew, in half of the cases without the 24 code points before."""
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    mixed = upper + lower + digits
    alphabets = (digits + "ABCDEF", digits + "abcdef", upper + "234567", lower + digits, mixed, mixed + "+/", mixed + "-_")
    parts, made, at, size = [], [], 0, 0
    for start, end in spans:
        kept = text[at:start]
        if chance.random() < 0.5 and len(kept) > 24:
            kept = kept[:-24].rstrip() + " "
        value = "".join(chance.choices(chance.choice(alphabets), k=chance.randint(16, 48)))
        if chance.random() < 0.2:
            value = "".join(chance.choices(lower, k=chance.randint(2, 4))) + "_" + value
        parts += [kept, value]
        size += len(kept)
        made.append((size, size + len(value)))
        size += len(value)
        at = end
    parts.append(text[at:])
    return "".join(parts), made


def _decoyed(text: str, chance: random.Random) -> str:
    """The text with things among its words that are no secrets: addresses, paths, numbers, dates, names."""

    def word() -> str:
        return "".join(chance.choices("aeiourstlnmdkp", k=chance.randint(2, 9)))

    def number(least: int, most: int) -> str:
        return "".join(chance.choices("0123456789", k=chance.randint(least, most)))

    makers = (
        lambda: f"https://www.{word()}.{word()[:3]}/{word()}/{word()}-{word()}?{word()[:2]}={number(1, 5)}",
        lambda: f"/{word()}/{word()}_{word()}/{word()}.{word()[:3]}",
        lambda: f"{word()}.{word()}{number(0, 3)}@{word()}.com",
        lambda: ".".join(number(1, 3) for _ in range(4)),
        lambda: f"{number(4, 4)}-{number(2, 2)}-{number(2, 2)}T{number(2, 2)}:{number(2, 2)}:{number(2, 2)}Z",
        lambda: number(5, 20),
        lambda: f"+{number(1, 3)}-{number(3, 3)}-{number(4, 7)}",
        lambda: "".join(word().capitalize() for _ in range(chance.randint(2, 5))),
        lambda: "_".join(word() for _ in range(chance.randint(2, 5))).upper(),
        lambda: word() + "".join(word().capitalize() for _ in range(2)) + f"({word()}_{number(1, 2)})",
        lambda: f"{word()}-{word()}-{word()}",
        lambda: f"v{number(1, 2)}.{number(1, 2)}.{number(1, 3)}-{word()}{number(1, 2)}",
    )
    words = text.split(" ")
    for _ in range(8):
        words.insert(chance.randrange(len(words) + 1), chance.choice(makers)())
    return " ".join(words)


def fit(windows: list[tuple[str, int]], seed: int = 11) -> Model:
    """Learns from windows of texts, each with the number of its kind of file."""
    model, chance, draws = Model(), random.Random(seed), np.random.default_rng(seed)
    examples = []
    for text, file in windows:
        spans = values(text)
        examples.append((text, spans, file))
        if spans:
            examples += [(*_redrawn(text, spans, chance), file) for _ in range(COPIES)]
        else:
            examples.append((_decoyed(text, chance), [], file))
    if not any(spans for _, spans, _ in examples):
        return model
    tokens = Tokens([e[0] for e in examples], [e[2] for e in examples])
    gold = np.full(len(tokens), O)
    centre = []
    for d, (_, spans, _) in enumerate(examples):
        low, high = int(tokens.first[d]), int(tokens.first[d + 1])
        starts, ends = tokens.start[low:high] - tokens.begins[d], tokens.end[low:high] - tokens.begins[d]
        spot = chance.randrange(low, high) if high > low else low
        for start, end in spans:
            a, b = low + int(np.searchsorted(ends, start, side="right")), low + int(np.searchsorted(starts, end, side="left"))
            gold[a:b] = I
            gold[a : a + 1] = B
            spot = a if b > a else spot
        centre.append((low, high, spot))
    # Crops of at most LENGTH tokens around the spots; shorter ones are filled with a token that counts nothing.
    usable = [c for c in centre if c[1] > c[0]]
    crops = np.full((len(usable), LENGTH), -1, np.int64)
    for i, (low, high, spot) in enumerate(usable):
        a = max(low, min(spot - chance.randrange(LENGTH), high - LENGTH))
        picked = np.arange(a, min(high, a + LENGTH))
        crops[i, : len(picked)] = picked
    rows = dict(tokens.features())
    for name, table_rows in rows.items():  # a feature that is seen once or twice says nothing about other texts
        seen = np.bincount(table_rows, minlength=GROUPS[name])
        rows[name] = np.where(seen[table_rows] > 2, table_rows, 0) if name not in ("gaps", "file") else table_rows
    past = {name: np.full_like(t, 1e-2) for name, t in (*model.tables.items(), ("move", model.move))}
    for _ in range(STEPS):
        crop = crops[draws.integers(len(crops), size=min(BATCH, 2 * len(crops)))]
        real = crop >= 0
        at = np.where(real, crop, 0)
        scores = sum(model.tables[name][r[at]] for name, r in rows.items()) * real[:, :, None]
        gradient, moved = _gradient(scores, gold[at], real, model.move)
        flat, chosen = gradient[real], at[real]
        for name, r in rows.items():
            change = np.stack([np.bincount(r[chosen], flat[:, j], GROUPS[name]) for j in range(3)], axis=1)
            _climb(model.tables[name], past[name], change / len(crop))
        _climb(model.move, past["move"], moved / len(crop))
    model.tables = {name: np.where(np.abs(t) > 1e-6, t, 0) for name, t in model.tables.items()}
    for name in rows:
        if name not in ("gaps", "file"):
            model.tables[name][0] = 0
    model.trained = True
    return model


def _climb(table: np.ndarray, past: np.ndarray, change: np.ndarray) -> None:
    past += change * change
    table += (RATE * change / np.sqrt(past) - 1e-4 * table).astype(np.float32)


def _gradient(scores: np.ndarray, gold: np.ndarray, real: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the log likelihood, for the scores and for the moves, by forward-backward; ``real`` tokens stand in front."""
    n, length, _ = scores.shape
    local = np.exp(scores - scores.max(axis=2, keepdims=True))
    step, start = np.exp(move[:3]), np.exp(move[3])
    ahead, back = np.empty_like(local), np.ones_like(local)
    for t in range(length):
        state = (ahead[:, t - 1] @ step if t else start) * local[:, t]
        ahead[:, t] = state / state.sum(axis=1, keepdims=True)
    for t in range(length - 2, -1, -1):
        onward = (local[:, t + 1] * back[:, t + 1]) @ step.T
        onward = np.where(real[:, t + 1, None], onward, 1.0)
        back[:, t] = onward / onward.sum(axis=1, keepdims=True)
    held = ahead * back
    held /= held.sum(axis=2, keepdims=True)
    gradient = (np.eye(3)[gold] - held) * real[:, :, None]
    moved = np.zeros_like(move)
    moved[3] = gradient[:, 0].sum(axis=0)
    for t in range(1, length):
        both = ahead[:, t - 1, :, None] * step[None] * (local[:, t] * back[:, t])[:, None, :]
        both /= both.sum(axis=(1, 2), keepdims=True)
        ok = real[:, t]
        moved[:3] -= both[ok].sum(axis=0)
        np.add.at(moved, (gold[ok, t - 1], gold[ok, t]), 1)
    return gradient, moved


def learn(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", per_kind: int = PER_KIND, window: int = WINDOW) -> Model:
    """A field fitted on windows around base spans and on others, at most ``per_kind`` of each."""
    keyed = docs.select(
        # By the text, too, as ids may be null or repeat.
        F.xxhash64(F.coalesce(F.col(key_col).cast("string"), F.lit("")), text_col, F.lit("secrets")).alias("draw"),
        F.col(text_col).alias("text"),
    ).where("text IS NOT NULL")

    def windows(around: bool):
        @F.pandas_udf("part string, file int")
        def cut(texts: pd.Series, draws: pd.Series) -> pd.DataFrame:
            rows = []
            for text, seed in zip(texts, draws, strict=True):
                chance = random.Random(int(seed))
                spans = values(text) if around else []
                spot = chance.choice(spans)[0] if spans else chance.randrange(len(text) + 1)
                begin = max(0, min(spot - chance.randrange(window // 2) - window // 4, len(text) - window))
                rows.append((text[begin : begin + window], int(Tokens([text]).files[0])))
            return pd.DataFrame(rows, columns=["part", "file"])

        return cut

    def share(salt: str) -> Column:
        return F.pmod(F.xxhash64("draw", F.lit(salt)), F.lit(1 << 30)) / float(1 << 30)

    def sample(some: DataFrame, around: bool) -> DataFrame:
        return some.select("draw", windows(around)("text", "draw").alias("w")).select("draw", "w.part", "w.file")

    def gathered(parts: DataFrame) -> list[tuple[str, int]]:
        """About a fifth more than wanted are drawn, whatever the number of tasks, and the rest is cut off."""
        rows = sorted(parts.collect(), key=lambda r: (r["draw"], r["part"]))
        return [(r["part"], r["file"]) for r in rows[:per_kind]]

    total = max(1, docs.count())
    pool = keyed.where(share("pool") < POOL * per_kind / total)
    hits = stored(sample(pool.where(F.col("text").rlike(HINT)), True), "hits")
    around = gathered(hits.where(share("hits") < 1.2 * per_kind / max(1, hits.count())))
    return fit(around + gathered(sample(keyed.where(share("any") < 1.2 * per_kind / total), False)))


def find_secrets(docs: DataFrame, model: Model, text_col: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """All rows with the base spans and all spans (``kind:start:end``, comma-joined, code points, end exclusive) and the
    number of each kind."""
    clash = {c.lower() for c in docs.columns} & {c.split()[0] for c in RESULT.split(", ")}
    if clash:
        raise ValueError(f"input columns would be hidden: {sorted(clash)}")
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def said(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)

    @F.pandas_udf(RESULT)
    def of(series: pd.Series) -> pd.DataFrame:
        texts = [t if isinstance(t, str) else "" for t in series]
        rows, done = [], 0
        while done < len(texts):
            n, size = done, 0
            while n < len(texts) and (n == done or size + len(texts[n]) <= CHUNK):
                size += len(texts[n])
                n += 1
            for base, spans in scan(shipped.value, texts[done:n], shortest):
                counts = [sum(s[2] == k for s in spans) for k in range(4)]
                rows.append((said(base), said(spans), *counts))
            done = n
        return pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    return docs.select(F.struct("*").alias("row"), of(F.col(text_col)).alias("found")).select("row.*", "found.*")
