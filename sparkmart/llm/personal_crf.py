"""Personal data: fixed patterns, and a semi-Markov conditional random field over whole spans.

The field labels stretches of up to ``LONGEST`` words as email, ip, card or phone, and single words as
nothing. The score of a stretch is a sum of weights of features of the *whole* stretch (how many
digits, in which groups, parted by what, whether a checksum holds, how an address is spelled, which
words stand around it) plus weights of its kind next to the kind before it. Dynamic programming over
stretch ends with a bounded length finds the best cut of a text into stretches with kinds; training
uses the same recursion with sums in place of maxima. Words that no candidate stretch covers are
nothing in every cut and cost nothing, so texts of any length are decoded island by island.

Candidates are stretches of words without letters and 4 to 20 digits, and stretches around an at
sign or a spelled one with a dot or a spelled one behind it.

The field is trained in numpy on windows of words from anywhere in whole texts: for
``TRAIN_TEXTS`` texts drawn by hash one window at a drawn place and one around a drawn match of the
patterns. Into them go addresses and numbers in the fixed forms and in other ones (spelled or spaced
addresses, numbers without a plus sign, other separators), and look-alikes that are no personal
data (dates, versions, amounts, book and order numbers, failed checksums). So the field finds forms
that no pattern has; its labels are not those of the patterns.

Base spans stay as they are; the field adds spans that touch none of theirs, named ``field_`` and
kind. Positions are code points, ends exclusive. NULL texts are empty and have no spans, repeated
rows are scanned each, an empty table gives no rows; without texts to train on the field adds
nothing. Further columns pass only where the caller names them.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import shared
from sparkmart.llm.words import Words, bytes_of, chunks

# The kinds in their order, and the patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

TRAIN_TEXTS = 2000
WINDOW = 24  # words of a training window
EPOCHS = 30
LONGEST = 9  # words of a stretch
NEAR = 12  # words of context that an island takes along

CONTEXT = {
    "email": ("email", "mail", "e-mail", "contact", "write", "reply"),
    "ip": ("ip", "host", "server", "addr", "address", "gateway", "dns", "client"),
    "card": ("card", "visa", "mastercard", "credit", "cc", "amex", "payment", "debit"),
    "phone": ("tel", "phone", "call", "fax", "mobile", "cell", "telephone", "sms", "dial"),
}
_CONTEXT = {w: k + 1 for k, kind in enumerate(KINDS) for w in CONTEXT[kind]}
AT_WORDS = {"at": 4, "[at]": 2, "(at)": 3, "{at}": 3, "<at>": 3, "@": 1}
DOT_WORDS = frozenset(("dot", "[dot]", "(dot)", "{dot}", "<dot>", ".", "punkt", "point"))
_INNER = re.compile(r"[\[({<](?:at|dot)[\])}>]", re.I)
_ENDING = re.compile(r"[a-z]{2,6}", re.I)

# Sizes of the feature slots: see ``Stretch``.
_SLOTS = (64, 16, 128, 256, 16, 10, 5, 10, 10, 48, 2, 16)
_OFFSETS = np.concatenate([[0], np.cumsum(_SLOTS)])
N_FEATURES = int(_OFFSETS[-1])


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k & 1:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the whole pattern, found from their at signs so that long runs are read once."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        tail = DOMAIN.match(text, at + 1) if start < at else None
        if tail:
            free = tail.end()
            yield start, free
            at = text.find("@", free)
        else:
            free = max(free, at + 1)
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, in order of start and then kind."""
    out = [(s, 0, e) for s, e in _emails(text)]
    for m in IP.finditer(text):  # a match always begins where a run of digits does
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m.groups()):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(map(str.isdigit, m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return [(s, KINDS[k], e) for s, k, e in sorted(out)]


class Word:
    """What candidates need to know of one word: its number part, or its part in an address."""

    __slots__ = ("groups", "seps", "letters", "context", "at", "dot", "left", "right", "start", "end", "inner", "number", "ending")

    def __init__(self, text: str):
        lower = text.lower()
        bare = lower.strip(".,;:!?=#*$%&|\"'")
        self.context = _CONTEXT.get(bare, 0)
        self.dot = lower in DOT_WORDS or bare in DOT_WORDS
        self.at = AT_WORDS.get(lower, 0)
        # A label before a colon or equals sign is context, not a part of the number.
        cut = max(text.rfind(":"), text.rfind("=")) + 1
        if cut and cut < len(text) and text[cut:].strip("*$%&|!?.,;\"'") and not text[:cut].strip(":=").isdigit() and "@" not in text[:cut]:
            self.context = self.context or _CONTEXT.get(lower[:cut].strip(".,;:=#\"'"), 0)
        else:
            cut = 0
        keep = [k for k, c in enumerate(text[cut:], cut) if c.isalnum()]
        self.start, self.end = (keep[0], keep[-1] + 1) if keep else (cut, cut)
        core = text[self.start : self.end]
        self.left = text[cut : self.start]
        self.right = text[self.end :]
        self.letters = any(c.isalpha() for c in core)
        self.groups = [len(g) for g in re.findall("[0-9]+", core)]
        self.number = bool(self.groups) and not self.letters and core.isascii()
        self.seps = set(re.sub("[A-Za-z0-9]", "", core))
        if self.number and self.left[-1:] in ("(", "+"):  # these belong to a number
            self.start -= 1
            self.seps.add(self.left[-1])
            if self.left[-2:] == "+(":
                self.start -= 1
                self.seps.add("+")
        self.inner = len(_INNER.findall(lower)) if "[" in text or "(" in text or "{" in text else 0
        if not self.at and ("@" in core or self.inner and any(m[1:3] == "at" for m in _INNER.findall(lower))):
            self.at = 1 if "@" in core else 2
            self.number = False
        # Spelled signs inside a word stand for the signs.
        plain = re.sub(r"[\[({<]dot[\])}>]", ".", re.sub(r"[\[({<]at[\])}>]", "@", lower))
        self.ending = plain.strip(".,;:!?\"'*$%&|#()[]").rsplit(".", 1)[-1].rsplit("@", 1)[-1]
        if not self.dot and (("." in plain.rpartition("@")[2].strip(".,;:!?*$%&|#") if "@" in plain else "." in core)):
            self.inner = max(self.inner, 1)
        else:
            self.inner = 0


class Lattice:
    """Candidate stretches of a list of words with their features."""

    def __init__(self, words: list[str]):
        self.words = words
        self.known = w = [Word(x) for x in words]
        self.begins: list[int] = []
        self.lengths: list[int] = []
        rows: list[list[int]] = []
        n = len(w)
        digits = [re.sub("[^0-9]", "", x[k.start : k.end]) if k.number else "" for x, k in zip(words, w)]
        for i in range(n):
            if w[i].number:
                total, groups, seps = "", [], set()
                for j in range(i, min(n, i + LONGEST)):
                    if not w[j].number:
                        if w[j].letters or len(words[j]) > 4 or w[j].dot and words[j] != "." and words[j].isalpha():
                            break
                        seps |= set(words[j])  # a sign on its own
                        continue
                    total += digits[j]
                    if len(total) > 20:
                        break
                    groups += w[j].groups
                    seps |= w[j].seps | ({" "} if j > i else set()) | (set(w[j].left + w[j - 1].right) if j > i else set())
                    if len(total) >= 4:
                        self._add(rows, i, j, total, groups, seps, 0, 0, False)
            if w[i].at:
                behind = range(i, min(n, i + 7))
                dots = 0
                for j in behind:
                    if j > i and w[j].at or j > i + 1 and not (w[j].dot or w[j - 1].dot):
                        break
                    dots += w[j].dot or w[j].inner > 0
                    solved = dots and not w[j].dot and (j > i or w[i].at < 4 and len(words[i]) > 5)
                    if not solved:
                        continue
                    for a in range(max(0, i - 5), i + 1):
                        if j - a + 1 > LONGEST or a == i and words[i].lower() in AT_WORDS or w[a].dot or any(w[x].at for x in range(a, i)):
                            continue
                        # Words before the sign are names parted by spelled dots.
                        if all(w[x].dot or w[x + 1].dot for x in range(a, i - 1)):
                            tail = bool(_ENDING.fullmatch(w[j].ending))
                            self._add(rows, a, j, "", [], set(), w[i].at, dots, tail)
        order = np.lexsort((self.lengths, self.begins)) if rows else []
        self.features = np.array(rows, np.int64).reshape(-1, len(_SLOTS))[order] + _OFFSETS[:-1]
        self.begins = np.array(self.begins, np.int64)[order]
        self.lengths = np.array(self.lengths, np.int64)[order]

    def _add(self, rows, i, j, total, groups, seps, at, dots, tail) -> None:
        w = self.known
        sets = (" ", "-_", ".", "()", "/:", ",", "+", "[]{}<>*")
        mask = sum(1 << k for k, s in enumerate(sets) if seps & set(s))
        quad = len(groups) == 4 and all(g <= 3 for g in groups) and max(map(int, _split(total, groups))) <= 255
        check = 13 <= len(total) <= 19 and luhn(total)
        before, two = w[i - 1] if i else None, w[i - 2] if i > 1 else None
        after = w[j + 1] if j + 1 < len(w) else None
        edge = lambda s: 0 if not s else 1 if s[-1] in "\"'([{" else 2 if s[-1] in ".,;:!?)]}" else 3
        self.begins.append(i)
        self.lengths.append(j - i + 1)
        rows.append([
            min(len(total), 31) + 32 * (at > 0),
            min(len(groups), 7) + 8 * (j > i),
            zlib.crc32(",".join(map(str, groups)).encode()) % 128,
            mask,
            check + 2 * quad + 4 * (total[:2] == "00" or total[:1] == "0") + 8 * (bool(groups) and max(groups) - min(groups) == 0),
            (before.context if before else 0) + 5 * bool(before and before.number) if not w[i].context else w[i].context,
            two.context if two else 0,
            (after.context if after else 0) + 5 * bool(after and after.number),
            j - i + 1,
            at + 6 * min(dots, 3) + 24 * tail,
            int(at > 0),
            edge(w[i].left[:1]) + 4 * edge(w[j].right[:1]),
        ])


def _split(digits: str, groups: list[int]) -> list[str]:
    out, at = [], 0
    for g in groups:
        out.append(digits[at : at + g])
        at += g
    return out


class Field:
    """Weights: ``unary`` features x kinds, ``pairs`` kind before (0: nothing) x kind."""

    def __init__(self):
        self.unary = np.zeros((N_FEATURES, len(KINDS)))
        self.pairs = np.zeros((len(KINDS) + 1, len(KINDS)))

    def scores(self, features: np.ndarray) -> np.ndarray:
        return self.unary[features].sum(axis=1)

    def decode(self, lattice: Lattice) -> list[tuple[int, int, int]]:
        """Best stretches as (first word, words, kind). Ties go to nothing, then to the earlier."""
        if not len(lattice.begins):
            return []
        return best_cut(len(lattice.words), lattice.begins, lattice.lengths, self.scores(lattice.features), self.pairs)

    def train(self, lattices: list[Lattice], gold: list[list[tuple[int, int, int]]], epochs: int = EPOCHS, rate: float = 0.4, decay: float = 2e-4) -> list[float]:
        """Gradient ascent of the exact log-likelihood; returns its mean by epoch."""
        use = [k for k, x in enumerate(lattices) if len(x.begins)]
        if not use:
            self.unary[:] = -1.0
            return []
        n, places = len(use), []
        at, features, target = [], [], []
        pairs_seen = np.zeros_like(self.pairs)
        for row, k in enumerate(use):
            x = lattices[k]
            # Runs of words that no candidate covers count as one word.
            covered = np.zeros(len(x.words) + 1, bool)
            for b, m in zip(x.begins.tolist(), x.lengths.tolist()):
                covered[b : b + m] = True
            place = np.cumsum(np.concatenate([[0], covered[:-1] | np.concatenate([[True], covered[:-2]])[: len(x.words)]]))
            places.append(place)
            wanted = {(b, m): kind for b, m, kind in gold[k]}
            last_end, last_kind = 0, 0
            for b, m, kind in sorted(gold[k]):
                pairs_seen[last_kind if last_end == b and b else 0, kind] += 1
                last_end, last_kind = b + m, kind + 1
            for f, b, m in zip(x.features, x.begins.tolist(), x.lengths.tolist()):
                at.append((row, place[b], m))
                features.append(f)
                target.append(wanted.get((b, m), -1))
        at_, features_, target_ = np.array(at), np.array(features), np.array(target)
        hit = np.flatnonzero(target_ >= 0)
        size = max(int(p[-1]) for p in places)
        square_u, square_p = np.full_like(self.unary, 1e-8), np.full_like(self.pairs, 1e-8)
        history = []
        for _ in range(epochs):
            scores = self.scores(features_)
            marginal, pairs, norm = _marginals(n, size, at_, scores, self.pairs)
            history.append(float((scores[hit, target_[hit]].sum() + (pairs_seen * self.pairs).sum() - norm) / n))
            diff = -marginal
            diff[hit, target_[hit]] += 1
            grad = np.zeros_like(self.unary)
            for slot in range(features_.shape[1]):
                for t in range(len(KINDS)):
                    grad[:, t] += np.bincount(features_[:, slot], weights=diff[:, t], minlength=N_FEATURES)
            grad = grad / n - decay * self.unary
            grad_p = (pairs_seen - pairs) / n - decay * self.pairs
            square_u += grad**2
            square_p += grad_p**2
            self.unary += rate * grad / np.sqrt(square_u)
            self.pairs += rate * grad_p / np.sqrt(square_p)
        return history


def best_cut(n: int, begins, lengths, scores: np.ndarray, pairs: np.ndarray) -> list[tuple[int, int, int]]:
    """Viterbi over stretch ends: ``best[j][k]`` is the best score of a cut of the first j words whose last
    stretch has kind k - 1 (0: nothing)."""
    kinds = len(KINDS)
    by_end: dict[int, list[int]] = {}
    for s, (b, m) in enumerate(zip(begins.tolist(), lengths.tolist())):
        by_end.setdefault(b + m, []).append(s)
    best = np.full((n + 1, kinds + 1), -np.inf)
    back: list[list] = [[None] * (kinds + 1) for _ in range(n + 1)]
    best[0, 0] = 0
    for j in range(1, n + 1):
        k = int(best[j - 1].argmax())
        best[j, 0], back[j][0] = best[j - 1, k], (j - 1, k)
        for s in by_end.get(j, ()):
            i = j - int(lengths[s])
            ways = best[i][:, None] + pairs
            k = ways.argmax(axis=0)
            value = ways[k, np.arange(kinds)] + scores[s]
            for t in np.flatnonzero(value > best[j, 1:]).tolist():
                best[j, 1 + t], back[j][1 + t] = value[t], (i, int(k[t]))
    out, j, k = [], n, int(best[n].argmax())
    while j:
        i, before = back[j][k]
        if k:
            out.append((i, j - i, k - 1))
        j, k = i, before
    return out[::-1]


def _marginals(n: int, size: int, at: np.ndarray, scores: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Marginals of all stretches and kinds, summed pair marginals, summed log-normalisers: forward and
    backward sums over all chains at once. Shorter chains end in words that are nothing."""
    kinds = len(KINDS)
    grid = np.full((size, LONGEST + 1, n, kinds), -np.inf)  # by begin and length
    grid[at[:, 1], at[:, 2], at[:, 0]] = scores
    lse = lambda x, axis: np.logaddexp.reduce(x, axis=axis)
    ahead = np.full((size + 1, n, kinds + 1), -np.inf)
    ahead[0, :, 0] = 0
    entry = np.empty((size + 1, n, kinds))  # all ways to a word, with the step into each kind
    for j in range(size + 1):
        if j:
            ahead[j, :, 0] = lse(ahead[j - 1], 1)
            for m in range(1, min(j, LONGEST) + 1):
                ahead[j, :, 1:] = np.logaddexp(ahead[j, :, 1:], entry[j - m] + grid[j - m, m])
        entry[j] = lse(ahead[j][:, :, None] + pairs[None], 1)
    rest = np.full((size + 1, n, kinds + 1), -np.inf)
    rest[size] = 0
    leave = np.full((size + 1, n, kinds), -np.inf)  # all ways from a word that begin with each kind
    for i in range(size - 1, -1, -1):
        for m in range(1, min(size - i, LONGEST) + 1):
            leave[i] = np.logaddexp(leave[i], grid[i, m] + rest[i + m][:, 1:])
        steps = lse(pairs[None] + leave[i][:, None, :], 2)
        rest[i] = np.logaddexp(rest[i + 1][:, :1], steps)
    norm = rest[0, :, 0]
    b, m, row = at[:, 1], at[:, 2], at[:, 0]
    with np.errstate(under="ignore"):
        marginal = np.exp(entry[b, row] + scores + rest[b + m, row][:, 1:] - norm[row][:, None])
        joint = np.zeros_like(pairs)
        for i in range(size):
            joint += np.exp(ahead[i][:, :, None] + pairs[None] + leave[i][:, None, :] - norm[:, None, None]).sum(axis=0)
    return marginal, joint, float(norm.sum())


class Forms:
    """Invented personal data and look-alikes, as words with a kind (-1: none)."""

    def __init__(self, seed: int):
        self.draw = random.Random(seed)

    def d(self, n: int, first: str = "") -> str:
        return first + "".join(self.draw.choice("0123456789") for _ in range(n - len(first)))

    def fill(self, shape: str) -> str:
        """A shape with digits for N, and 2 to 9 for P."""
        return "".join(self.d(1) if c == "N" else self.draw.choice("23456789") if c == "P" else c for c in shape)

    def name(self) -> str:
        return "".join(self.draw.choice("abcdefghijklmnoprstuvw") for _ in range(self.draw.randint(3, 9)))

    def card(self, n: int = 16) -> str:
        body = self.d(n - 1, self.draw.choice("3456"))
        return next(body + c for c in "0123456789" if luhn(body + c))

    def octets(self) -> list[str]:
        return [str(self.draw.choice((self.draw.randint(0, 255), self.draw.randint(0, 30), 192, 10))) for _ in range(4)]

    def phone(self) -> str:
        shapes = ("+N (PNN) PNN-NNNN", "+NN NN NNNN NNNN", "(PNN) PNN-NNNN", "PNN-PNN-NNNN", "PNN.PNN.NNNN", "0NN NNNN NNNN", "00NN NNN NNN NNNN",
                  "N-PNN-PNN-NNNN", "0NNN-NNNNNNN", "PNN PNN NNNN", "0NNN NNN NNN", "(0NN) NNNN NNNN", "(0NNN) NNNNNN", "0NN/NNNNNNN")
        return self.fill(self.draw.choice(shapes))

    def email(self) -> str:
        a, b, h, e = self.name(), self.name(), self.name(), self.draw.choice(("com", "org", "net", "de", "fr", "es", "io", "co", "info"))
        shapes = (f"{a}.{b}@{h}.{e}", f"{a} at {h} dot {e}", f"{a} [at] {h} [dot] {e}", f"{a}(at){h}(dot){e}", f"{a} @ {h}.{e}", f"{a}[at]{h}[dot]{e}",
                  f"{a} at {h}.{e}", f"{a} dot {b} at {h} dot {e}", f"{a} (at) {h} dot {b} dot {e}", f"{a}.{b} [at] {h}.{e}", f"{a}[at]{h}.{e}")
        return self.draw.choice(shapes)

    def ip(self) -> str:
        x = self.octets()
        return self.draw.choice((".", ".", "[.]", " . ", "(.)", "[.]", " [.] ")).join(x)

    def number(self) -> str:
        c = self.card(16) if self.draw.random() < 0.8 else self.card(15)
        parts = [c[:4], c[4:8], c[8:12], c[12:]] if len(c) == 16 else [c[:4], c[4:10], c[10:]]
        return self.draw.choice((" ", "-", "", ".", "/", "_", " - ", " . ", ".")).join(parts)

    def other(self) -> str:
        x = self.octets()
        failed = next(c for c in iter(lambda: self.d(16, "4"), "") if not luhn(c))
        fours = " ".join((failed[:4], failed[4:8], failed[8:12], failed[12:]))
        shapes = ("20NN-0P-1N", "1N.0P.20NN", "0P/1N/20NN 1N:NN", "1N.N.P", "N.N.N.N.N", "$N,NNN,NNN.NN", "N NNN NNN", "978-N-NN-NNNNNN-N", "20NN-NNNNNN-NN",
                  "19NN 20NN 20NN 19NN", "NN N NN NN N", "1N:NN:NN", "N.NNNNNNNN", "NN.NN%", "NN-NN-NN", "NNN.NNN.NNN,NN", "#NNNNNNNN", "NNNNNNNNNN", "NNNNNNN",
                  "NNNN-NNNN", "page NNN of NNNN", "NNN NNN", "20NNNNNNTNNNNNN", "NN:NN NN-NN-20NN", "NNNNNNNNNNNN", "NN NNNN", "P.NN NN.N P.NNN N.NN")
        words = (f"{self.name()} at {self.name()}", f"{self.name()} at {self.name()} . {self.name()}", f"{self.name()} dot {self.name()}",
                 f"look at dot {self.name()}", f"{self.name()} @ {self.name()}", f"at {self.name()} {self.name()}.", f"@{self.name()}")
        pick = self.draw.random()
        if pick < 0.7:
            return self.fill(self.draw.choice(shapes))
        if pick < 0.85:
            return self.draw.choice((failed, fours, failed[:4] + "-" + failed[4:8] + "-" + failed[8:12] + "-" + failed[12:], f"{x[0]}.{self.d(3, '9')}.{x[2]}.{x[3]}", f"{self.d(3, '7')}.{x[1]}.{x[2]}"))
        return self.draw.choice(words)

    def one(self) -> tuple[int, str, str]:
        """Kind, text, and a word before it ('': none)."""
        kind = self.draw.choice((0, 1, 2, 3, -1, -1, -1, -1, -1))
        text = (self.email, self.ip, self.number, self.phone, self.other)[kind]()
        if kind >= 0 and self.draw.random() < 0.3:
            lead = self.draw.choice(CONTEXT[KINDS[kind]]) + self.draw.choice(("", ":", " is"))
        elif kind < 0 and self.draw.random() < 0.4:
            lead = self.draw.choice(("order", "version", "page", "date:", "isbn", "id", "total", "since", "section", "no."))
        else:
            lead = ""
        return kind, text, lead


def labelled(windows: list[list[str]], seed: int = 11) -> tuple[list[Lattice], list[list[tuple[int, int, int]]]]:
    """Lattices with their right stretches: each window with one or two invented items in drawn places."""
    forms = Forms(seed)
    lattices, gold = [], []
    for words in windows:
        marks = [(-1, 0)] * len(words)  # kind and number of the item that a word belongs to
        # Matches of the patterns that the window holds are right ones too.
        line, starts = " ".join(words), []
        at = 0
        for w in words:
            starts.append(at)
            at += len(w) + 1
        for number, (s, kind, e) in enumerate(base_spans(line)):
            for k, w in enumerate(words):
                if starts[k] < e and s < starts[k] + len(w) and marks[k][0] < 0:
                    marks[k] = (KINDS.index(kind), -1 - number)
        words = list(words)
        for number in range(1, forms.draw.choice((1, 2, 2)) + 1):
            kind, text, lead = forms.one()
            spots = [k for k in range(len(words) + 1) if not 0 < k < len(words) or marks[k][1] == 0 or marks[k][1] != marks[k - 1][1]]
            spot = forms.draw.choice(spots)
            tail = forms.draw.choice(("", "", "", ".", ",", "!!", ")"))
            new, ahead = (text + tail).split(), lead.split()
            words[spot:spot] = ahead + new
            marks[spot:spot] = [(-1, 0)] * len(ahead) + [(kind, number)] * len(new)
        found, k = [], 0
        while k < len(words):
            e = k + 1
            while e < len(words) and marks[e] == marks[k]:
                e += 1
            if marks[k][0] >= 0:
                found.append((k, e - k, marks[k][0]))
            k = e
        lattice = Lattice(words)
        stretches = set(zip(lattice.begins.tolist(), lattice.lengths.tolist()))
        if all((b, m) in stretches for b, m, _ in found):
            lattices.append(lattice)
            gold.append(found)
    return lattices, gold


def train(docs: DataFrame, texts: int = TRAIN_TEXTS, seed: int = 5) -> Field:
    """A field from windows of about ``texts`` texts drawn by hash, read as a whole in the tasks; at most
    two windows of ``WINDOW`` words of a text, and 2 * ``texts`` rows in all, reach the driver."""
    import pyarrow as pa

    def task(batches) -> Iterator:
        for batch in batches:
            out: list[tuple[int, str]] = []
            for draw, text in zip(batch.column("draw").to_pylist(), batch.column("text").to_pylist()):
                pick = random.Random(draw)
                words = text.split()
                places = [pick.randrange(len(words))] if words else []
                spans = base_spans(text)
                if spans:
                    places.append(len(text[: pick.choice(spans)[0]].split()))
                for p in places:
                    begin = max(0, p - pick.randrange(WINDOW))
                    out.append((draw, " ".join(w[:200] for w in words[begin : begin + WINDOW])))
            yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in out], pa.int64()), pa.array([w for _, w in out], pa.string())], ["draw", "words"])

    text = F.col("text").cast("string")
    draw = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), text), F.lit(1 << 40))
    share = min(1.0, texts / max(1, docs.count()))
    some = docs.where(text.isNotNull() & (draw < int(share * (1 << 40)))).select(draw.alias("draw"), text.alias("text"))
    windows = some.mapInArrow(task, "draw long, words string").distinct()  # repeated rows are drawn together
    rows = windows.orderBy("draw", "words").limit(2 * texts).collect()
    field = Field()
    field.train(*labelled([r.words.split() for r in rows]))
    return field


def _anchors(w: Words) -> np.ndarray:
    """Words that a candidate may have: with a digit, an at sign or a bracket, or a spelled at sign."""
    flag = np.zeros(len(w.data) + 1, np.int32)
    data = w.data
    flag[1:] = ((data >= 48) & (data <= 57)) | (data == 64) | (data == 91) | (data == 123) | (data == 40)
    run = np.cumsum(flag)
    short = np.flatnonzero((w.ends - w.starts == 2) & (data[w.starts] | 32 == 97))
    spelled = short[(data[w.starts[short] + 1] | 32) == 116]
    out = run[w.ends] > run[w.starts]
    out[spelled] = True
    return np.flatnonzero(out)


def scan(docs: DataFrame, field: Field, keep: list[str], with_text: bool = False) -> DataFrame:
    """All spans of each whole text as an array of (kind, start, end), beside the columns of ``keep``.

    ``with_text`` adds the text with every span replaced by its kind in brackets.
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
                w = Words(part, offsets[i : j + 1] - offsets[i])
                anchors = _anchors(w)
                cuts = np.searchsorted(anchors, w.at)
                for row in range(j - i):
                    raw = part[w.offsets[row] : w.offsets[row + 1]].tobytes()
                    text = raw.decode()
                    spans = base_spans(text) if "@" in text or _DIGIT.search(text) else []
                    mine = anchors[cuts[row] : cuts[row + 1]]
                    if len(mine):
                        spans += shared.clear_of(spans, _added(w, row, raw, mine, model))
                        spans.sort(key=lambda x: (x[0], NAMES.index(x[1])))
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


NAMES = KINDS + tuple(f"field_{k}" for k in KINDS)
_DIGIT = re.compile("[0-9]")


def _added(w: Words, row: int, raw: bytes, anchors: np.ndarray, model: Field) -> list[tuple[int, str, int]]:
    """Spans of the field in one text, island by island."""
    out: list[tuple[int, str, int]] = []
    base = int(w.offsets[row])
    first, last = int(w.at[row]), int(w.at[row + 1])
    begins = np.flatnonzero(np.concatenate([[True], np.diff(anchors) > 2 * NEAR]))
    ends = np.concatenate([begins[1:], [len(anchors)]]) - 1
    points = None
    for b, e in zip(anchors[begins].tolist(), anchors[ends].tolist()):
        i, j = max(first, b - NEAR), min(last, e + NEAR + 1)
        words = [w.data[s:t].tobytes().decode() if t - s <= 400 else "x" for s, t in zip(w.starts[i:j].tolist(), w.ends[i:j].tolist())]
        lattice = Lattice(words)
        for at, m, kind in model.decode(lattice):
            if points is None:  # code points before each byte
                points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
            head, tail = lattice.known[at], lattice.known[at + m - 1]
            start = int(points[int(w.starts[i + at]) - base]) + head.start
            end = int(points[int(w.starts[i + at + m - 1]) - base]) + tail.end
            out.append((start, f"field_{KINDS[kind]}", end))
    return out


def mask(text: str, spans: list[tuple[int, str, int]]) -> str:
    """The text with every span, or union of overlapping spans, replaced by the first one's kind."""
    out, at, reached = [], 0, -1
    for start, kind, end in sorted(spans):
        if start > reached:
            out += [text[at:start], f"[{kind.removeprefix('field_').upper()}]"]
        reached = max(reached, end)
        at = max(at, end)
    return "".join(out) + text[at:]


def digest(spans: list[dict]) -> tuple[str, str]:
    line = ",".join(f"{x['kind']}:{x['start']}:{x['end']}" for x in spans if x["kind"] in KINDS)
    return line, hashlib.sha256(line.encode()).hexdigest()


def op12_semi_markov_pii(spark, sf_dir: str) -> DataFrame:
    """Spans of personal data of every document, as counts, a digest and a list."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = scan(docs, train(docs), ["doc_id"])

    def joined(spans):
        one = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
        return F.array_join(F.transform(spans, one), ",")

    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda x: x["kind"].isin(*KINDS))
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )
