"""Personal data: fixed patterns, plus a linear-chain conditional random field over word shapes.

The field is trained on the driver from a small labelled table (`LABELLED` unless another is given).
It decodes all words of the lines that have a digit or an at sign; neighbouring lines of that kind are
one chain, so an item may go on over a line's end, and over words without digits such as an IBAN's
bank code. Chains of a whole slice of texts are decoded together, by Viterbi in numpy.

Null texts are empty texts; null ids stay null; repeated rows are scanned each for itself; extra
columns are ignored; an empty table gives an empty result. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from quillstack.llm.common import mapped

BASE = ("email", "ip", "card", "phone")
LEARNED = ("crf_email", "crf_phone", "crf_ip", "crf_card", "crf_id")

# Labelled text: <kind ...> marks one item, everything else is outside.
LABELLED = (
    "call me at <phone 555-010-4477> before noon", "phone <phone (555) 010-4477> or come by",
    "tel <phone 020 7946 0958> ext", "my number is <phone 555.010.4471> thanks", "fax <phone 030 555 0199> office",
    "ring <phone +1 (523) 555-1055> today", "on <phone +44 20 7946 0958> now", "mobile <phone 0171 555 0142>",
    "the ssn <id 078-05-1120> was filed", "social security number <id 219-09-9999> is void",
    "iban <id DE44 5001 0517 5407 3249 31> please", "account <id GB29 NWBK 6016 1331 9268 19> closed",
    "passport <id C01X00T47> expired", "tax id <id 12-3456789> on file", "insured under <id 123-45-6789> since",
    "write to <email jo.doe@example.org> soon", "mail <email a.b+c@mail.example.com> again",
    "contact <email office@example> internal", "from <email x1@host> to <email y2@host> relay",
    "card <card 4111 1111 1111 1111> was used", "paid by <card 5500-0000-0000-0004> once",
    "charge <card 4785380592391139> now", "server <ip 10.0.0.12> is down", "ping <ip 192.168.1.254> first",
    "see page 12 of 48", "in 1998 and 2004 there were 17 cases", "version 2.14 of build 20231105",
    "on 2021-03-04 at 10:45 we met", "costs 12.50 or 1,200 in all", "chapter 3 section 4.2.1 holds",
    "room 204 floor 2", "about 50% of 300 people", "id 4f2a9c001d77e0b3 of the commit", "sum of 3 4 5 and 6 is 18",
    "token 24be64439e3e49cf46b2d7c90f3602a3d0b907ff ends", "sha 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b ok",
    "born 12/03/1985 in town", "score 10 to 2 in game 7", "99 bottles 98 bottles", "item 0012 row 17 col 4",
    "http://host/a1/b2 and file_v2.txt here", "error 404 or 500 again", "weights 1.5 2.5 3.5 total 7.5",
    "the 1st 2nd and 3rd of 10", "lot 123-45 and 67-8", "part a1b2 c3d4", "line 5551234 of the log",
)

CRF_CARD = len(BASE) + LEARNED.index("crf_card")
TAGS = ("O", *(f"{p}-{k[4:]}" for k in LEARNED for p in "BI"))
BUCKETS = 1024
WORD = re.compile(r"[^\x20\x09-\x0D]+")
TRIGGER = re.compile(r"[0-9@]")
#: What does not belong to an item at either end of a word.
TRIM_LEFT, TRIM_RIGHT = re.compile(r"[^A-Za-z0-9@+(]+"), re.compile(r"[^A-Za-z0-9@)]+$")

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def _emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches: each at sign takes the local part before it, from the last match's end on."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at) if start < at else None
        if domain:
            end = domain.end()
            out.append((start, end))
        at = text.find("@", max(end, at + 1))
    return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind, then start."""
    if not TRIGGER.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) < 256 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        if len(m[0]) >= 13:
            digits = re.sub("[^0-9]", "", m[0])
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(c in "0123456789" for c in m[0]) <= 15]
    return out


def _shape(word: str) -> str:
    """Letters as x or X (runs collapsed), digits as d (runs up to 5), all else as it is."""
    out = []
    for c in word[:40]:
        k = "d" if c in "0123456789" else "X" if c.isupper() else "x" if c.isalpha() else c
        if k == "d" and out[-5:] == ["d"] * 5 or k in "xX" and out[-1:] == [k]:
            continue
        out.append(k)
    return "".join(out)


def _core(word: str) -> str:
    return TRIM_RIGHT.sub("", TRIM_LEFT.sub("", word, count=1)) or word[:40]


def _of_core(core: str) -> tuple[str, ...]:
    digits = sum(c in "0123456789" for c in core)
    return f"s{_shape(core)}", f"d{min(digits, 20)}", f"l{min(len(core), 24) // 3}", f"a{'@' in core}"


def _bucket(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % BUCKETS


def _features(words: list[str], i: int) -> list[int]:
    """Buckets of one word's features: its shape, its length, and its neighbours' shapes and words."""
    core = _core(words[i])
    before = words[i - 1] if i else "<"
    after = words[i + 1] if i + 1 < len(words) else ">"
    raw = (
        *_of_core(core), f"p{_shape(before)}", f"n{_shape(after)}", f"w{before.lower()[:20]}",
        f"ps{_shape(before)}|{_shape(core)}", f"sn{_shape(core)}|{_shape(after)}", "bias",
    )
    return [_bucket(f) for f in raw]


def runs(text: str) -> list[tuple[list[str], list[tuple[int, int]], int, int]]:
    """Words of neighbouring lines with a digit or an at sign: (all words, their offsets, first, past last)."""
    if not TRIGGER.search(text):
        return []
    words, offsets, out, first, at = [], [], [], None, 0
    for line in text.split("\n"):
        found = [(m.group(), (at + m.start(), at + m.end())) for m in WORD.finditer(line)]
        at += len(line) + 1
        if not found:
            continue
        hot = TRIGGER.search(line) is not None
        if hot and first is None:
            first = len(words)
        elif not hot and first is not None:
            out.append((words, offsets, first, len(words)))
            first = None
        words += [w for w, _ in found]
        offsets += [o for _, o in found]
    if first is not None:
        out.append((words, offsets, first, len(words)))
    return out


def _codes(items: list) -> tuple[list, np.ndarray]:
    """Distinct items and every item's number among them."""
    known: dict = {}
    codes = [known.setdefault(x, len(known)) for x in items]
    return list(known), np.array(codes, np.int64)


@dataclass
class Field:
    """Emission weights (bucket, tag) and transitions (tag, tag); runs start and end outside."""

    emit: np.ndarray
    step: np.ndarray

    def scores(self, feats: np.ndarray) -> np.ndarray:
        return self.emit[feats].sum(axis=-2)

    def of_words(self, words: list[str]) -> np.ndarray:
        """Scores of all words of a sequence, the sums over `_features`, each distinct part summed once."""
        distinct, at = _codes(["<", ">", *words])
        before, at, after = np.r_[0, at[2:-1]], at[2:], np.r_[at[3:], 1]
        sums = lambda rows: self.scores(np.array([[_bucket(f) for f in r] for r in rows]))
        cores = [_core(w) for w in distinct]
        shapes, core_of = _codes([_shape(w) for w in distinct] + [_shape(c) for c in cores])
        shape_of, core_of = core_of[: len(distinct)], core_of[len(distinct) :]
        out = sums([(*_of_core(c), "bias") for c in cores])[at]
        out += sums([(f"w{w.lower()[:20]}",) for w in distinct])[before]
        out += sums([(f"p{x}",) for x in shapes])[shape_of[before]]
        out += sums([(f"n{x}",) for x in shapes])[shape_of[after]]
        for name, left, right in (("ps", shape_of[before], core_of[at]), ("sn", core_of[at], shape_of[after])):
            pairs, pair_of = np.unique(left * len(shapes) + right, return_inverse=True)
            pairs = [(f"{name}{shapes[p // len(shapes)]}|{shapes[p % len(shapes)]}",) for p in pairs.tolist()]
            out += sums(pairs)[pair_of]
        return out

    def decode(self, scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Best tags of padded runs (run, position, tag), all runs a position at a time."""
        n, size, _ = scores.shape
        best = self.step[0] + scores[:, 0]
        back = np.zeros((n, size, scores.shape[2]), np.int8)
        for t in range(1, size):
            paths = best[:, :, None] + self.step[None]
            back[:, t] = paths.argmax(axis=1)
            live = (t < lengths)[:, None]
            best = np.where(live, paths.max(axis=1) + scores[:, t], best)
        tags = np.zeros((n, size), np.int64)
        last = (best + self.step[:, 0]).argmax(axis=1)
        rows = np.arange(n)
        for t in range(size - 1, -1, -1):
            inside = t < lengths
            tags[:, t] = np.where(inside, last, 0)
            last = np.where(inside & (t > 0), back[rows, t, last], last)
        return tags


def labelled_runs(lines) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features and tags of the runs of a labelled table."""
    out = []
    for line in lines:
        words, tags = [], []
        for piece in re.findall(r"<\w+ [^>]*>|[^<>]+", line):
            marked = re.fullmatch(r"<(\w+) ([^>]*)>", piece)
            part = (marked[2] if marked else piece).split()
            words += part
            tags += [TAGS.index(f"{'I' if k else 'B'}-{marked[1]}") if marked else 0 for k in range(len(part))]
        if any(TRIGGER.search(w) for w in words):
            out.append((np.array([_features(words, i) for i in range(len(words))]), np.array(tags)))
    return out


def train(lines=LABELLED, sweeps: int = 150, rate: float = 0.2, decay: float = 0.002) -> Field:
    """Gradient ascent on the labelled runs' likelihood, by the forward and backward sums."""
    data, tags = labelled_runs(lines), len(TAGS)
    emit, step = np.zeros((BUCKETS, tags)), np.zeros((tags, tags))
    inside = [i for i in range(tags) if TAGS[i][0] == "I"]
    for i in inside:  # an item's later words follow its first or a later one
        step[[j for j in range(tags) if TAGS[j][2:] != TAGS[i][2:]], i] = -20.0
    fixed = step < 0
    log_sum = lambda a, axis: np.logaddexp.reduce(a, axis=axis)
    for _ in range(sweeps):
        d_emit, d_step = -decay * emit, np.where(fixed, 0.0, -decay * step)
        for feats, gold in data:
            s, n = emit[feats].sum(axis=1), len(gold)
            ahead, behind = np.zeros((n, tags)), np.zeros((n, tags))
            ahead[0], behind[-1] = step[0] + s[0], step[:, 0]
            for t in range(1, n):
                ahead[t] = log_sum(ahead[t - 1][:, None] + step, 0) + s[t]
            for t in range(n - 2, -1, -1):
                behind[t] = log_sum(step + (s[t + 1] + behind[t + 1])[None], 1)
            total = log_sum(ahead[-1] + behind[-1], 0)
            p = np.exp(ahead + behind - total)
            for t in range(n):
                err = -p[t]
                err[gold[t]] += 1
                np.add.at(d_emit, feats[t], err)
            path = [0, *gold, 0]
            for a, b in zip(path, path[1:], strict=False):
                d_step[a, b] += 1
            d_step[0] -= p[0]
            d_step[:, 0] -= p[-1]
            for t in range(1, n):
                d_step -= np.exp(ahead[t - 1][:, None] + step + (s[t] + behind[t])[None] - total)
        emit += rate * d_emit / 4
        step = np.where(fixed, step, step + rate * d_step / 4)
    return Field(emit, step)


def learned_spans(model: Field, texts: list[str], batch: int = 400_000) -> list[list[tuple[int, int, int]]]:
    """Per text the field's (kind, start, end), kinds numbered after the base ones; `batch` is in padded words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    todo = sorted(((k, r) for k, t in enumerate(texts) for r in runs(t)), key=lambda x: x[1][2] - x[1][3])
    lo = 0
    while lo < len(todo):
        longest = todo[lo][1][3] - todo[lo][1][2]
        part = todo[lo : lo + max(1, batch // longest)]
        lo += len(part)
        lengths = np.array([r[3] - r[2] for _, r in part])
        # The words of all chains with their outer neighbours, one behind the other.
        around = [[words[a - 1] if a else "<", *words[a:b], words[b] if b < len(words) else ">"] for _, (words, _, a, b) in part]
        sums = model.of_words([w for x in around for w in x])
        scores, at = np.zeros((len(part), longest, len(TAGS))), 0
        for k, n in enumerate(lengths.tolist()):
            scores[k, :n] = sums[at + 1 : at + 1 + n]
            at += n + 2
        for (text_at, (words, offsets, a, _)), tags, size in zip(part, model.decode(scores, lengths), lengths, strict=True):
            open_at = None
            for t in range(size + 1):
                tag = TAGS[tags[t]] if t < size else "O"
                if open_at is not None and tag[0] != "I":
                    first, last = a + open_at, a + t - 1
                    start = offsets[first][0] + len(TRIM_LEFT.match(words[first])[0] if TRIM_LEFT.match(words[first]) else "")
                    cut = TRIM_RIGHT.search(words[last])
                    end = offsets[last][1] - (len(cut[0]) if cut else 0)
                    kind = len(BASE) + LEARNED.index(f"crf_{TAGS[tags[open_at]][2:]}")
                    if start < end:
                        out[text_at].append((kind, start, end))
                    open_at = None
                if tag[0] == "B":
                    open_at = t
    return out


def find(model: Field, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """All spans of every text: base ones, and learned ones that touch no base one; by kind, then start.

    Learned card numbers count only if they pass the same checksum as base ones.
    """
    out = []
    for text, extra in zip(texts, learned_spans(model, texts), strict=True):
        base = base_spans(text)
        by_start = sorted((a, b) for _, a, b in base)
        starts = np.array([a for a, _ in by_start], np.int64)
        reach = np.maximum.accumulate(np.array([b for _, b in by_start], np.int64)) if by_start else starts
        free = []
        for kind, a, b in extra:
            k = int(np.searchsorted(starts, b))  # base spans that start before this one ends
            digits = re.sub("[^0-9]", "", text[a:b])
            if kind == CRF_CARD and not (13 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if not k or reach[k - 1] <= a:
                free.append((kind, a, b))
        out.append(base + sorted(free))
    return out


def scan(docs: DataFrame, model: Field | None = None) -> DataFrame:
    """`doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans` of every row of `docs (doc_id, text)`."""
    model = model or train()
    names = (*BASE, *LEARNED)

    def work(ids: list, texts: list) -> dict:
        found = find(model, texts)
        listing = lambda s: ",".join(f"{names[k]}:{a}:{b}" for k, a, b in s)
        base = [[s for s in x if s[0] < len(BASE)] for x in found]
        out = {f"n_{k}": [sum(s[0] == i for s in x) for x in base] for i, k in enumerate(BASE)}
        digest = [hashlib.sha256(listing(x).encode()).hexdigest() for x in base]
        return out | {"doc_id": ids, "base_sha256": digest, "spans": [listing(x) for x in found]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} bigint" for k in BASE)
    return mapped(docs.select("doc_id", "text"), work, f"doc_id {kind}, {counts}, base_sha256 string, spans string")


def query(docs: DataFrame) -> DataFrame:
    return scan(docs)
