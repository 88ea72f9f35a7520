"""Secret scan: fixed patterns, and a linear-chain conditional random field over tokens.

Tokens are words; each is tagged begin (B), inside (I) or outside (O) of a secret. Scores are sums
of weights: of the token's shape (classes of its characters, length, how often classes change), of
the words around it, of features of the whole text (the file), and of transitions. The field is
trained here, in numpy, by gradient ascent of the exact log-likelihood (forward-backward).

Its labels go beyond the fixed patterns. ``TRAIN_TEXTS`` texts are drawn by hash; of each, whole, one
window of ``WINDOW`` words from a drawn place and one around a drawn match come to the driver, at most
2 * ``TRAIN_TEXTS`` rows. Into them go invented secrets in forms that no pattern has (after a keyword
without a sign or with words between, keys with known prefixes, mixed alphabets) and look-alikes that
are none (addresses of pages with hashes, paths, names in code, versions, plain uses of the keywords).

Decoding is exact Viterbi over whole texts, of any length. A token whose O score leads by more than
twice the range of the transitions is O in every best path, because exchanging its tag for O gains
more than both transitions can cost; what lies between such tokens is decoded on its own.

Fixed patterns stay as they are; the field adds spans that touch none of theirs. Positions are code
points, ends exclusive. NULL texts are empty and have no spans, repeated rows are scanned each, an
empty table gives no rows; without texts to train on the field adds nothing. Further columns pass
only where the caller names them.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import shared
from sparkmart.llm.words import Words, bytes_of, chunks

# The kinds of secrets in their order, and the patterns.
KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key", "key", "bearer", "credential", "auth")

TRAIN_TEXTS = 2000
WINDOW = 24  # words of a training window
TAGS = 3  # O, B, I

_CLASS = np.zeros(256, np.uint8)  # 0 other, 1 lower, 2 upper, 3 digit, 4 sign, 5 beyond ASCII
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 5
_CLASS[list(b"+/_=-:\"'.")] = 4
N_SHAPE = 2 * 2 * 2 * 2 * 8 * 6
N_NEAR = len(KEYWORDS) + 1
N_FILE = 8
N_TURNS = 8 * 2 * 2 * 4
_OFFSETS = np.cumsum([0, N_SHAPE, N_NEAR, N_NEAR, N_FILE, N_NEAR, N_TURNS])
N_FEATURES = int(_OFFSETS[-1])


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, in order of start and then kind."""
    out = []
    lower = text.lower()
    if any(k in lower for k in ("password", "passwd", "secret", "token", "api")):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _long_hex(text)]
    return [(s, KINDS[k], e) for s, k, e in sorted(out)]


_HEX_RUN = re.compile(r"[0-9a-f]{24,}")


def _long_hex(text: str) -> Iterator[re.Match]:
    """Runs are maximal either way, so asking for 24 characters drops just the shorter ones."""
    return _HEX_RUN.finditer(text)


class Tokens:
    """Features of the words of some texts, from byte classes and hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.words = w = Words(data, offsets)
        n = len(w)
        self.features = np.zeros((n, 6), np.int32)
        if not n:
            return
        kinds = _CLASS[data]
        edges = np.stack([w.starts, w.ends], 1).ravel()
        counts = []
        for k in (1, 2, 3, 4, 5):
            sums = np.concatenate([[0], np.cumsum(kinds == k, dtype=np.int32)])[edges].reshape(-1, 2)
            counts.append(sums[:, 1] - sums[:, 0])
        lower, upper, digit, sign, beyond = counts
        length = w.ends - w.starts
        size = np.searchsorted([4, 8, 12, 16, 20, 24, 32], length, side="right")
        mixed = np.minimum(5, (5 * (digit + upper)) // length)
        shape = (lower > 0) + 2 * (upper > 1) + 4 * (digit > 0) + 8 * (sign > 1)
        self.features[:, 0] = (shape * 8 + size) * 6 + mixed
        near = _keywords(w)
        before = np.concatenate([[0], near[:-1]])
        after = np.concatenate([near[1:], [0]])
        before[w.at[:-1][np.diff(w.at) > 0]] = 0
        after[(w.at[1:] - 1)[np.diff(w.at) > 0]] = 0
        # A keyword in the token itself counts as one before it.
        before = np.where(near > 0, near, before)
        self.features[:, 1] = N_SHAPE + before
        self.features[:, 2] = N_SHAPE + N_NEAR + after
        digits = np.concatenate([[0], np.cumsum(digit)])[w.at]
        signs = np.concatenate([[0], np.cumsum(sign)])[w.at]
        total = np.maximum(1, np.diff(w.at))
        file = (np.diff(digits) > total).astype(int) + 2 * (np.diff(signs) > total) + 4 * (total > 1000)
        self.features[:, 3] = N_SHAPE + 2 * N_NEAR + np.repeat(file, np.diff(w.at))
        # The keyword of the word before the one before.
        two = np.concatenate([[0, 0], near[:-2]])[:n]
        place = np.arange(n) - np.repeat(w.at[:-1], np.diff(w.at))
        self.features[:, 4] = _OFFSETS[4] + np.where(place < 2, 0, two)
        # How often the kind of character changes, and marks of addresses and paths.
        change = np.zeros(len(data) + 1, np.int32)
        change[2:] = kinds[1:] != kinds[:-1]
        turns = np.cumsum(change)[edges].reshape(-1, 2)
        turns = np.searchsorted([1, 2, 4, 6, 9, 13, 18], turns[:, 1] - turns[:, 0] - 1, side="right")
        marks = [np.cumsum(np.concatenate([[0], data == c]), dtype=np.int32)[edges].reshape(-1, 2) for c in (47, 64, 46)]
        slash, at, dot = (m[:, 1] > m[:, 0] for m in marks)
        head = w.data[w.starts]
        opens = np.select([(head == 34) | (head == 39), _CLASS[head] == 2, _CLASS[head] == 3], [1, 2, 3], 0)
        self.features[:, 5] = _OFFSETS[5] + ((turns * 2 + (slash | at)) * 2 + dot) * 4 + opens


_WORD_KEYS: dict[str, np.ndarray] = {}


def _keywords(w: Words) -> np.ndarray:
    """For each word, 1 + the first keyword that it begins with after signs, 0 if none."""
    if not _WORD_KEYS:
        for form in ("{}", "{}:", "{}=", '"{}":', "'{}':", '"{}"', "{},", "{}."):
            data = "".join(form.format(k) + " " for k in KEYWORDS).encode()
            made = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
            _WORD_KEYS[form] = made.hashes()
    out = np.zeros(len(w), np.int64)
    hashes = w.hashes()
    for row in _WORD_KEYS.values():
        order = np.argsort(row)
        at = np.minimum(np.searchsorted(row[order], hashes), len(row) - 1)
        hit = row[order][at] == hashes
        out = np.where(hit & (out == 0), order[at] + 1, out)
    long = np.flatnonzero((w.ends - w.starts > 12) & (out == 0))
    for i in long.tolist():  # assignments without blanks
        word = w.data[w.starts[i] : w.ends[i]].tobytes().lower()
        for k, key in enumerate(KEYWORDS):
            if key.encode() in word:
                out[i] = k + 1
                break
    return out


class Field:
    """Weights of the field. ``unary``: features x tags; ``pairs``: tag x next tag."""

    def __init__(self):
        self.unary = np.zeros((N_FEATURES, TAGS))
        self.pairs = np.zeros((TAGS, TAGS))

    def scores(self, features: np.ndarray) -> np.ndarray:
        out = self.unary[features[:, 0]]
        for k in range(1, features.shape[1]):
            out = out + self.unary[features[:, k]]
        return out

    def train(self, chains: list[tuple[np.ndarray, np.ndarray]], epochs: int = 40, rate: float = 0.5, decay: float = 1e-4) -> list[float]:
        """Gradient ascent with per-weight step sizes; returns the mean log-likelihood by epoch."""
        chains = [c for c in chains if len(c[0])]
        if not chains:
            self.unary[:, 0] = 1.0
            return []
        longest = max(len(f) for f, _ in chains)
        n = len(chains)
        tags = np.zeros((n, longest), np.int64)
        mask = np.zeros((n, longest), bool)
        flat = np.concatenate([f for f, _ in chains])
        for i, (f, y) in enumerate(chains):
            tags[i, : len(y)], mask[i, : len(y)] = y, True
        gold = np.concatenate([y for _, y in chains])
        joint = mask[:, 1:]
        seen_pairs = np.zeros((TAGS, TAGS))
        np.add.at(seen_pairs, (tags[:, :-1][joint], tags[:, 1:][joint]), 1)
        square_u, square_p = np.full_like(self.unary, 1e-8), np.full_like(self.pairs, 1e-8)
        history = []
        for _ in range(epochs):
            emit = np.zeros((n, longest, TAGS))
            emit[mask] = self.scores(flat)
            unary, pairs, norm = _marginals(emit, self.pairs, mask)
            gold_score = emit[mask][np.arange(len(gold)), gold].sum() + (seen_pairs * self.pairs).sum()
            history.append((gold_score - norm) / len(gold))
            diff = -unary[mask]
            diff[np.arange(len(gold)), gold] += 1
            grad = np.zeros_like(self.unary)
            for k in range(flat.shape[1]):
                for t in range(TAGS):
                    grad[:, t] += np.bincount(flat[:, k], weights=diff[:, t], minlength=N_FEATURES)
            grad = grad / n - decay * self.unary
            grad_p = (seen_pairs - pairs) / n - decay * self.pairs
            square_u += grad**2
            square_p += grad_p**2
            self.unary += rate * grad / np.sqrt(square_u)
            self.pairs += rate * grad_p / np.sqrt(square_p)
        return history

    def decode(self, features: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Best tags of all tokens; ``at`` are the bounds of the texts."""
        tags = np.zeros(len(features), np.int8)
        if not len(features):
            return tags
        scores = self.scores(features)
        lead = scores[:, 0] - scores[:, 1:].max(axis=1)
        open_ = lead <= 2 * (self.pairs.max() - self.pairs.min())
        first = np.zeros(len(features) + 1, bool)
        first[at] = True
        idx = np.flatnonzero(open_)
        if not len(idx):
            return tags
        new = np.concatenate([[True], (np.diff(idx) > 1) | first[idx[1:]]])
        begins = np.flatnonzero(new)
        for b, e in zip(begins.tolist(), [*begins[1:].tolist(), len(idx)]):
            i, j = int(idx[b]), int(idx[e - 1]) + 1
            left = 0 if not first[i] else -1  # the neighbours are O, or there are none
            right = 0 if not first[j] else -1
            tags[i:j] = viterbi(scores[i:j], self.pairs, left, right)
        return tags


def viterbi(scores: np.ndarray, pairs: np.ndarray, left: int = -1, right: int = -1) -> np.ndarray:
    """Best tags of one chain between given outer tags (-1: none). Ties go to the smaller tag."""
    n = len(scores)
    back = np.zeros((n, TAGS), np.int8)
    best = scores[0] + (pairs[left] if left >= 0 else 0)
    for t in range(1, n):
        ways = best[:, None] + pairs
        back[t] = ways.argmax(axis=0)
        best = ways.max(axis=0) + scores[t]
    if right >= 0:
        best = best + pairs[:, right]
    out = np.zeros(n, np.int8)
    out[-1] = best.argmax()
    for t in range(n - 1, 0, -1):
        out[t - 1] = back[t, out[t]]
    return out


def _marginals(emit: np.ndarray, pairs: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Tag marginals, summed pair marginals and summed log-normalisers, by scaled forward-backward."""
    n, length, _ = emit.shape
    top = emit.max(axis=2, keepdims=True)
    local, move = np.exp(emit - top), np.exp(pairs)
    forward, scale = np.zeros_like(emit), np.ones((n, length))
    for t in range(length):
        now = local[:, t] if t == 0 else (forward[:, t - 1] @ move) * local[:, t]
        total = now.sum(axis=1)
        live = mask[:, t]
        scale[live, t] = total[live]
        forward[:, t] = now / np.where(live, total, 1)[:, None] * live[:, None]
    backward = np.ones_like(emit)
    joint = np.zeros((TAGS, TAGS))
    for t in range(length - 1, 0, -1):
        live = mask[:, t]
        ahead = local[:, t] * backward[:, t] / scale[:, t, None]
        joint += np.einsum("na,nb->ab", forward[:, t - 1][live], ahead[live]) * move
        backward[:, t - 1] = np.where(live[:, None], ahead @ move.T, 1)
    unary = forward * backward
    norm = float((np.log(scale) + top[:, :, 0])[mask].sum())
    return unary, joint, norm


def gold_tags(text: str, words: Words, row: int = 0) -> np.ndarray:
    """Tags of a text's words by the fixed patterns; ``words`` holds this text alone."""
    tags = np.zeros(len(words), np.int64)
    points = np.concatenate([[0], np.cumsum((words.data & 0xC0) != 0x80)])
    starts, ends = points[words.starts], points[words.ends]
    reached = 0
    for start, _, end in base_spans(text):
        if end <= reached:
            continue
        hit = np.flatnonzero((ends > start) & (starts < end))
        hit = hit[tags[hit] == 0]
        if len(hit):
            tags[hit[0]], tags[hit[1:]] = 1, 2
        reached = end
    return tags


class Forms:
    """Invented secrets and look-alikes: words, and which of them are the secret."""

    LOWER, UPPER, DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    PREFIXES = ("ghp_", "sk-", "sk_live_", "xoxb-", "pk_test_", "glpat-", "npm_", "AIza", "eyJ")

    def __init__(self, seed: int):
        self.draw = random.Random(seed)

    def of(self, letters: str, least: int, most: int) -> str:
        return "".join(self.draw.choice(letters) for _ in range(self.draw.randint(least, most)))

    def key(self) -> str:
        every = self.LOWER + self.UPPER + self.DIGIT
        kind = self.draw.randrange(6)
        if kind == 0:
            return self.draw.choice(self.PREFIXES) + self.of(every, 16, 40)
        if kind == 1:
            return self.of(every + "+/", 36, 44) + self.draw.choice(("", "=", "=="))
        if kind == 2:
            return self.of(every, 16, 40)
        if kind == 3:
            return self.of(self.UPPER + self.DIGIT, 16, 32)
        if kind == 4:
            return self.of(every + "!@#$%^*_-", 10, 18)
        return self.of(every, 8, 12) + "." + self.of(every, 16, 30) + "." + self.of(every + "_-", 16, 30)

    def word(self) -> str:
        return self.of(self.LOWER, 3, 10)

    def secret(self) -> tuple[list[str], int, int]:
        """Words, and the range of them that is the secret."""
        quote = self.draw.choice(("", "", "", '"', "'"))
        value = quote + self.key() + quote + self.draw.choice(("", "", ".", ","))
        key = self.draw.choice(KEYWORDS)
        key = self.draw.choice((key, key.upper(), key.title()))
        lead = self.draw.choice(([key], [key, "is"], [key, "->"], [key, "=>"], [key, "was"], ["Bearer"], ["Authorization:", "Bearer"], [], ["my", key], [key + ",", "namely"]))
        return [*lead, value], len(lead), len(lead) + 1

    def other(self) -> list[str]:
        every = self.LOWER + self.DIGIT
        hexes = self.of("0123456789abcdef", 7, 12)
        shapes = (
            f"https://{self.word()}.org/{self.word()}/{self.of(every, 20, 40)}", f"http://{self.word()}.com/?q={self.word()}&id={self.of(self.DIGIT, 6, 12)}",
            f"/usr/{self.word()}/{self.word()}/{self.word()}.py", f"{self.word()}_{self.word()}_{self.word()}()", f"{self.word().title()}{self.word().title()}{self.word().title()}",
            f"{self.word()}@{self.word()}.com", f"v{self.of(self.DIGIT, 1, 2)}.{self.of(self.DIGIT, 1, 2)}.{self.of(self.DIGIT, 1, 2)}", hexes, self.of(self.DIGIT, 8, 19),
            f"{self.word().upper()}-{self.of(self.DIGIT, 4, 8)}", f"{self.word().upper()}", f"{self.word()}-{self.word()}-{self.word()}-{self.word()}",
            f"{self.word()}.{self.word()}.{self.word()}", f"2024-0{self.of('123456789', 1, 1)}-1{self.of(self.DIGIT, 1, 1)}T10:{self.of('12345', 1, 1)}0:00Z", f"#{self.of(self.DIGIT, 3, 6)}",
            f"{self.of('0123456789ABCDEF', 6, 8)}", f"ISBN-{self.of(self.DIGIT, 13, 13)}", f"{self.of(self.LOWER, 20, 40)}", f"{self.word()}{self.of(self.DIGIT, 1, 4)}",
        )
        key = self.draw.choice(KEYWORDS)
        plain = ([key, self.word()], [key, "is", self.word()], ["the", key, "of", self.word()], [key, "ring"], [key, "->", self.word()], [key + ",", self.word()], [key, self.of(self.DIGIT, 1, 3)])
        pick = self.draw.random()
        if pick < 0.55:
            return [self.draw.choice(shapes)]
        if pick < 0.7:
            return [self.draw.choice(("see", "commit", "file", "order", "id", key)), self.draw.choice(shapes[:10])]
        return list(self.draw.choice(plain))


def train(docs: DataFrame, texts: int = TRAIN_TEXTS, seed: int = 7) -> Field:
    """A field from windows of about ``texts`` texts drawn by hash, read as a whole in the tasks."""
    import pyarrow as pa

    def task(batches) -> Iterator:
        for batch in batches:
            out: list[tuple[int, str]] = []
            for draw, text in zip(batch.column("draw").to_pylist(), batch.column("text").to_pylist()):
                out += [(draw, w) for w in windows_of(text, random.Random(draw))]
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in out], pa.int64()), pa.array([w for _, w in out], pa.string())], ["draw", "words"])

    text = F.col("text").cast("string")
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), text), F.lit(1 << 40))
    share = min(1.0, texts / max(1, docs.count()))
    some = docs.where(text.isNotNull() & (draw < int(share * (1 << 40)))).select(draw.alias("draw"), text.alias("text"))
    rows = some.mapInArrow(task, "draw long, words string").distinct()  # repeated rows are drawn together
    return fit_windows([r.words.split() for r in rows.orderBy("draw", "words").limit(2 * texts).collect()])


def windows_of(text: str, pick: random.Random) -> list[str]:
    """A window of words from anywhere in the text, and one around one of its matches, if any."""
    words = text.split()
    places = [pick.randrange(len(words))] if words else []
    spans = base_spans(text)
    if spans:
        places.append(len(text[: pick.choice(spans)[0]].split()))
    out = []
    for p in places:
        begin = max(0, p - pick.randrange(WINDOW))
        out.append(" ".join(w[:200] for w in words[begin : begin + WINDOW]))
    return out


def fit(texts: list[str], seed: int = 3) -> Field:
    """Train on windows of the given texts."""
    pick = random.Random(seed)
    return fit_windows([w.split() for text in texts for w in windows_of(text, pick)])


def fit_windows(windows: list[list[str]], seed: int = 17) -> Field:
    """Train on windows with one or two invented items each; what the patterns match is right too."""
    forms, chains = Forms(seed), []
    for words in windows:
        made: list[tuple[str, int]] = [(w, 0) for w in words]
        for _ in range(forms.draw.choice((1, 1, 2))):
            spot = forms.draw.randint(0, len(made))
            if forms.draw.random() < 0.4:
                new, begin, end = forms.secret()
            else:
                new, begin, end = forms.other(), 0, 0
            made[spot:spot] = [(w, 1 if k == begin < end else 2 if begin < k < end else 0) for k, w in enumerate(new)]
        text = " ".join(w for w, _ in made)
        raw = np.frombuffer(text.encode(), np.uint8)
        tokens = Tokens(raw, np.array([0, len(raw)]))
        planted = np.array([t for _, t in made], np.int64)
        if len(tokens.words) == len(planted):  # other blanks of Unicode part words for split() only
            tags = gold_tags(text, tokens.words)
            chains.append((tokens.features, np.where(planted > 0, planted, tags)))
    field = Field()
    field.train(chains)
    return field


def scan(docs: DataFrame, field: Field, keep: list[str], with_text: bool = False) -> DataFrame:
    """All spans of each whole text as an array of (kind, start, end), beside the columns of ``keep``.

    ``with_text`` adds the text with every span replaced by ``[SECRET]``.
    """
    import pyarrow as pa

    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    shipped = docs.sparkSession.sparkContext.broadcast((field.unary, field.pairs))  # fixed size

    def task(batches) -> Iterator:
        model = Field()
        model.unary, model.pairs = shipped.value
        for batch in batches:
            data, offsets = bytes_of(batch.column("_text"))
            found: list[list[dict]] = []
            masked: list[str] = []
            for i, j in chunks(offsets):
                part = data[offsets[i] : offsets[j]]
                tokens = Tokens(part, offsets[i : j + 1] - offsets[i])
                w = tokens.words
                tags = model.decode(tokens.features, w.at)
                hits = np.flatnonzero(tags)
                owner = np.searchsorted(w.at, hits, side="right") - 1
                added: dict[int, list[tuple[int, int]]] = {}
                for h, row in zip(hits.tolist(), owner.tolist()):
                    runs = added.setdefault(row, [])
                    if tags[h] == 2 and runs and runs[-1][1] == h:
                        runs[-1] = (runs[-1][0], h + 1)
                    else:
                        runs.append((h, h + 1))
                for row in range(j - i):
                    start = int(w.offsets[row])
                    raw = part[start : int(w.offsets[row + 1])].tobytes()
                    text = raw.decode()
                    spans = base_spans(text)
                    if row in added:
                        # Code points before each byte.
                        before = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
                        points = lambda b: int(before[int(b) - start])  # noqa: B023, E731
                        more = [trimmed(text, points(w.starts[a]), points(w.ends[b - 1])) for a, b in added[row]]
                        spans += shared.clear_of(spans, [x for x in more if x[0] < x[2]])
                        spans.sort(key=lambda x: (x[0], KINDS.index(x[1])))
                    found.append([{"kind": k, "start": s, "end": e} for s, k, e in spans])
                    if with_text:
                        masked.append(mask(text, spans))
            columns = [batch.column(c) for c in keep] + [pa.array(found, pa.list_(span))]
            columns += [pa.array(masked, pa.string())] * with_text
            yield pa.RecordBatch.from_arrays(columns, keep + ["spans"] + ["masked"] * with_text)

    rows = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    declared = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema if f.name != "_text")
    declared += "spans array<struct<kind:string,start:bigint,end:bigint>>" + ", masked string" * with_text
    return rows.mapInArrow(task, declared)


def trimmed(text: str, start: int, end: int) -> tuple[int, str, int]:
    """A span of the field without quotes and sentence signs around it."""
    core = text[start:end]
    left = len(core) - len(core.lstrip("\"'`([{<"))
    return start + left, "crf", start + max(left, len(core.rstrip("\"'`)]}>.,;:!?*$%&|#")))


def mask(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with every span, or union of overlapping spans, replaced by ``[SECRET]``."""
    out, at, reached = [], 0, -1
    for start, _, end in sorted(spans):
        if start > reached:
            out += [text[at:start], "[SECRET]"]
        reached = max(reached, end)
        at = max(at, end)
    return "".join(out) + text[at:]


def digest(spans: list[dict]) -> tuple[str, str]:
    line = ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in spans if x["kind"] != "crf")
    return line, hashlib.sha256(line.encode()).hexdigest()


def op8_secret_crf(spark, sf_dir: str) -> DataFrame:
    """Spans of secrets of every document, as counts, a digest and a list."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan(docs, train(docs), ["doc_id"])

    def joined(spans):
        one = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
        return F.array_join(F.transform(spans, one), ",")

    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"] != "crf")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
