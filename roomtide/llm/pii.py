"""Personal data by patterns and a character-level BiLSTM-CRF.

Base spans come from fixed patterns. The tagger adds spans that the patterns miss:
a bidirectional LSTM over character classes scores the tags of every character, a
CRF adds transitions between tags, and the best path is taken. It is trained in
numpy from labelled spans: the base spans of a bounded sample of documents, part
of them rewritten in other notations, and text without any.

A text is read in overlapping windows. An added span must hold a digit or an `@` and
pass its kind's check, so windows are laid around these characters: each has MARGIN
characters on both sides in some window, so a span of up to MARGIN is held whole
wherever it stands, and text far from them is not decoded. What the windows say is
reconciled over the whole text: pieces of a longer span, cut by the edges of windows
that overlap, are joined; a piece that does not go on in the next window is dropped;
equal spans are one; of overlapping spans the base ones stay, then the better scored.

Defined results: a null or empty text has no spans; spans are in code points, end
exclusive; a row given twice has the same spans twice; very long texts are read whole,
window by window; an empty table gives no rows, and a network that was trained on no
rows is a random one; other columns are kept, and one that has the name of a result is
an error unless a prefix is given.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as tx

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]

# --- base patterns (fixed values of the data contract) ---------------------------------
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > done and text[begin - 1] in LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        if found:
            yield begin, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    # Runs of digits and dots, cut at the dots, so that a long number costs no retries.
    for run in _DOTTED.finditer(text):
        if "." not in run[0]:
            continue
        parts, at, places = run[0].split("."), run.start(), []
        for p in parts:
            places.append(at)
            at += len(p) + 1
        i = 0
        while i + 4 <= len(parts):
            four = parts[i:i + 4]
            if all(four):
                if all(len(p.lstrip("0")) <= 3 and int(p[-4:] if len(p) > 3 else p) <= 255
                       for p in four):
                    yield places[i], places[i + 3] + len(parts[i + 3])
                i += 4
            else:
                i += 1


def base_spans(text: str) -> list[Span]:
    """(kind, start, end) of the fixed patterns, leftmost and non-overlapping per kind."""
    spans = [(0, a, b) for a, b in _emails(text)]
    spans += [(1, a, b) for a, b in _ips(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            spans.append((3, m.start(), m.end()))
    return sorted(spans, key=lambda s: (s[1], s[0], s[2]))


# --- characters and tags ---------------------------------------------------------------
_SINGLE = "@.-+()_%/,:;[]{}<>=|#*!?'\"&$\\"
_LOWER, _UPPER, _DIGIT, _SPACE, _LETTER, _OTHER, _PAD = range(7)
CLASSES = 7 + len(_SINGLE)
TAGS = 1 + 2 * len(KINDS)


def _class_table() -> np.ndarray:
    table = np.full(256, _OTHER, dtype=np.uint8)
    for p in range(256):
        c = chr(p)
        if "a" <= c <= "z":
            table[p] = _LOWER
        elif "A" <= c <= "Z":
            table[p] = _UPPER
        elif "0" <= c <= "9":
            table[p] = _DIGIT
        elif p in tx.SEPARATORS:
            table[p] = _SPACE
        elif c in _SINGLE:
            table[p] = 7 + _SINGLE.index(c)
        elif c.isalpha():
            table[p] = _LETTER
    return table


CLASS_OF = _class_table()


def classes(points: np.ndarray) -> np.ndarray:
    """Character classes; code points above 255 are letters or others by their range."""
    return np.where(points < 256, CLASS_OF[np.minimum(points, 255)],
                    np.where(points < 0x2000, _LETTER, _OTHER)).astype(np.uint8)


def _allowed() -> np.ndarray:
    """Tag changes: an inside tag only follows its own kind."""
    ok = np.ones((TAGS, TAGS), dtype=bool)
    for k in range(len(KINDS)):
        ok[:, 2 + 2 * k] = False
        ok[1 + 2 * k, 2 + 2 * k] = ok[2 + 2 * k, 2 + 2 * k] = True
    return ok


ALLOWED = _allowed()
_NEVER = -1e4


# --- the network -----------------------------------------------------------------------
HIDDEN = 16
# Characters of a training window, and of one that is decoded.
WINDOW = 128
STRETCH = 768
MARGIN = 200
# Windows decoded at a time: some 25 MB of arrays.
TOGETHER = 128


def new_network(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {}
    for d in "fb":
        p[f"x{d}"] = rng.normal(0, 0.3, (CLASSES, 4 * HIDDEN))
        p[f"h{d}"] = rng.normal(0, 0.5 / np.sqrt(HIDDEN), (HIDDEN, 4 * HIDDEN))
        p[f"b{d}"] = np.concatenate((np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)))
    p["out"] = rng.normal(0, 0.3, (2 * HIDDEN, TAGS))
    p["bias"] = np.concatenate(([1.0], np.zeros(TAGS - 1)))
    p["move"] = np.zeros((TAGS, TAGS))
    return p


def _direction(p, d: str, x: np.ndarray, keep: bool):
    """Hidden states of a batch of windows x (time, window), and what training needs."""
    steps, n = x.shape
    kind = p[f"h{d}"].dtype
    h, c = np.zeros((n, HIDDEN), kind), np.zeros((n, HIDDEN), kind)
    table = p[f"x{d}"] + p[f"b{d}"]
    out, saved = np.empty((steps, n, HIDDEN), kind), []
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        gates = table[x[t]] + h @ p[f"h{d}"]
        # Three gates by the logistic function, written with tanh, and the candidate.
        gates[:, :3 * HIDDEN] *= 0.5
        np.tanh(gates, out=gates)
        gates[:, :3 * HIDDEN] += 1
        gates[:, :3 * HIDDEN] *= 0.5
        i, f, o, g = (gates[:, k * HIDDEN:(k + 1) * HIDDEN] for k in range(4))
        before, c = c, f * c + i * g
        squashed = np.tanh(c)
        if keep:
            saved.append((t, gates, before, squashed, h))
        h = o * squashed
        out[t] = h
    return out, saved


def emissions(p, x: np.ndarray) -> np.ndarray:
    fore, _ = _direction(p, "f", x, False)
    back, _ = _direction(p, "b", x, False)
    return fore @ p["out"][:HIDDEN] + back @ p["out"][HIDDEN:] + p["bias"]


def _back(p, d: str, x: np.ndarray, saved, slope: np.ndarray, grad) -> None:
    n = x.shape[1]
    dh, dc = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
    for t, gates, before, squashed, h in reversed(saved):
        i, f, o, g = (gates[:, k * HIDDEN:(k + 1) * HIDDEN] for k in range(4))
        dh = dh + slope[t]
        dc = dc + dh * o * (1 - squashed ** 2)
        dz = np.concatenate((dc * g * i * (1 - i), dc * before * f * (1 - f),
                             dh * squashed * o * (1 - o), dc * i * (1 - g ** 2)), axis=1)
        np.add.at(grad[f"x{d}"], x[t], dz)
        grad[f"h{d}"] += h.T @ dz
        grad[f"b{d}"] += dz.sum(0)
        dh, dc = dz @ p[f"h{d}"].T, dc * f


def _log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _step(p, x: np.ndarray, y: np.ndarray):
    """Mean CRF loss of a batch per character and its gradient."""
    steps, n = x.shape
    fore, saved_f = _direction(p, "f", x, True)
    back, saved_b = _direction(p, "b", x, True)
    both = np.concatenate((fore, back), axis=2)
    e = both @ p["out"] + p["bias"]
    move = np.where(ALLOWED, p["move"], _NEVER)
    alpha, beta = np.empty_like(e), np.zeros_like(e)
    alpha[0] = e[0]
    for t in range(1, steps):
        alpha[t] = e[t] + _log_sum(alpha[t - 1][:, :, None] + move, 1)
    for t in range(steps - 2, -1, -1):
        beta[t] = _log_sum(move + (e[t + 1] + beta[t + 1])[:, None, :], 2)
    total = _log_sum(alpha[-1], 1)
    rows = np.arange(n)
    gold = sum(e[t, rows, y[t]] for t in range(steps)) + \
        sum(move[y[t - 1], y[t]] for t in range(1, steps))
    de = np.exp(alpha + beta - total[None, :, None])
    grad = {k: np.zeros_like(v) for k, v in p.items()}
    for t in range(1, steps):
        pair = alpha[t - 1][:, :, None] + move + (e[t] + beta[t])[:, None, :] - total[:, None, None]
        grad["move"] += np.exp(pair).sum(0)
        np.add.at(grad["move"], (y[t - 1], y[t]), -1)
    for t in range(steps):
        de[t, rows, y[t]] -= 1
    scale = 1 / (n * steps)
    de *= scale
    grad["move"] *= scale * ALLOWED
    grad["out"] = np.tensordot(both, de, axes=((0, 1), (0, 1)))
    grad["bias"] = de.sum((0, 1))
    dh = de @ p["out"].T
    _back(p, "f", x, saved_f, dh[:, :, :HIDDEN], grad)
    _back(p, "b", x, saved_b, dh[:, :, HIDDEN:], grad)
    return float((total - gold).sum() * scale), grad


def learn(x: np.ndarray, y: np.ndarray, rounds: int = 14, batch: int = 64, rate: float = 0.02,
          seed: int = 11) -> dict[str, np.ndarray]:
    """A network from windows x and their tags y (window, time); same data, same network."""
    p = new_network(seed)
    rng = np.random.default_rng(seed)
    one = {k: np.zeros_like(v) for k, v in p.items()}
    two = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for r in range(rounds if len(x) else 0):
        speed = rate * (1 - 0.8 * r / rounds)
        for own in np.array_split(rng.permutation(len(x)), max(1, len(x) // batch)):
            _, grad = _step(p, x[own].T, y[own].T)
            size = np.sqrt(sum((g ** 2).sum() for g in grad.values()))
            step += 1
            for k, g in grad.items():
                g = g * min(1.0, 1.0 / max(size, 1e-12))
                one[k] = 0.9 * one[k] + 0.1 * g
                two[k] = 0.99 * two[k] + 0.01 * g * g
                p[k] -= speed * (one[k] / (1 - 0.9 ** step)) / (
                    np.sqrt(two[k] / (1 - 0.99 ** step)) + 1e-8)
    p["move"] = np.where(ALLOWED, p["move"], _NEVER)
    return {k: v.astype(np.float32) for k, v in p.items()}


def best_paths(p, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tags (time, window) of the best path, and each tag's margin over `outside`."""
    steps, n, _ = e.shape
    score, came = e[0], np.empty((steps, n, TAGS), dtype=np.int8)
    for t in range(1, steps):
        ways = score[:, :, None] + p["move"]
        came[t] = ways.argmax(axis=1)
        score = e[t] + ways.max(axis=1)
    tags = np.empty((steps, n), dtype=np.int8)
    tags[-1] = score.argmax(axis=1)
    rows = np.arange(n)
    for t in range(steps - 1, 0, -1):
        tags[t - 1] = came[t, rows, tags[t]]
    margin = np.take_along_axis(e, tags[:, :, None].astype(np.int64), 2)[:, :, 0] - e[:, :, 0]
    return tags, margin


# --- training data ---------------------------------------------------------------------
# Bounds on the documents that spans are learned from, on the spans of each, and on the
# windows made of them.
SAMPLE_DOCS = 1500
SAMPLE_SPANS = 4
SAMPLE_WINDOWS = 640


def _another(kind: int, text: str, rng) -> str:
    """The same datum in another notation."""
    pick = int(rng.integers(4))
    if kind == 0:
        return (text, text.replace("@", " @ "), text.replace("@", "[@]"), text.upper())[pick]
    if kind == 1:
        return (text, f"{text}:{rng.integers(80, 9999)}", text, f"{text}/24")[pick]
    digits = _NOT_DIGIT.sub("", text)
    if kind == 2:
        four = [digits[i:i + 4] for i in range(0, len(digits), 4)]
        return (text, ".".join(four), "-".join(four), " ".join(four))[pick]
    a, b, c = digits[-10:-7], digits[-7:-4], digits[-4:]
    return (text, f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}")[pick]


def windows_of(texts: list[str], bound: int = SAMPLE_WINDOWS, seed: int = 5):
    """Training windows and tags; half of the spans are rewritten, a third hold none."""
    rng = np.random.default_rng(seed)
    found = [(t, s) for t in texts for s in base_spans(t)]
    by = [[f for f in found if f[1][0] == k] for k in range(len(KINDS))]
    xs, ys = [], []
    share = bound * 2 // (3 * len(KINDS))
    for kind, own in enumerate(by):
        for i in range(share if own else 0):
            text, (_, a, b) = own[int(rng.integers(len(own)))]
            said = _another(kind, text[a:b], rng) if rng.random() < 0.6 else text[a:b]
            left = int(rng.integers(8, max(9, WINDOW - len(said) - 8)))
            before, after = text[max(0, a - left):a], text[b:b + WINDOW]
            others = base_spans(before + " " * len(said) + after)
            piece = before + said + after
            tags = np.zeros(len(piece), dtype=np.int8)
            for k, c, d in [*others, (kind, len(before), len(before) + len(said))]:
                tags[c] = 1 + 2 * k
                tags[c + 1:d] = 2 + 2 * k
            xs.append(piece[:WINDOW])
            ys.append(tags[:WINDOW])
    for _ in range(bound - len(xs) if texts else 0):
        text = texts[int(rng.integers(len(texts)))]
        numbers = [m.start() for m in re.finditer("[0-9@|=:]", text)][:200]
        at = int(rng.integers(max(1, len(text)))) if not numbers or rng.random() < 0.5 \
            else max(0, numbers[int(rng.integers(len(numbers)))] - int(rng.integers(WINDOW)))
        piece = text[at:at + WINDOW]
        # Numbers that are no personal data: short ones, amounts, codes.
        if rng.random() < 0.5 and len(piece) > 40:
            cut = int(rng.integers(len(piece)))
            what = (str(rng.integers(10 ** int(rng.integers(1, 9)))),
                    f"{rng.integers(9999)}.{rng.integers(99)}", f"{rng.integers(1900, 2100)}-01-02",
                    "".join("0123456789abcdef"[j] for j in rng.integers(0, 16, 40)),
                    f"v{rng.integers(9)}.{rng.integers(9)}.{rng.integers(9)}")[int(rng.integers(5))]
            piece = (piece[:cut] + " " + what + " " + piece[cut:])[:WINDOW]
        tags = np.zeros(len(piece), dtype=np.int8)
        for k, c, d in base_spans(piece):
            tags[c] = 1 + 2 * k
            tags[c + 1:d] = 2 + 2 * k
        xs.append(piece)
        ys.append(tags)
    x = np.full((len(xs), WINDOW), _PAD, dtype=np.uint8)
    y = np.zeros((len(xs), WINDOW), dtype=np.int8)
    for i, (piece, tags) in enumerate(zip(xs, ys)):
        x[i, :len(piece)] = classes(np.array([ord(c) for c in piece], dtype=np.uint32))
        y[i, :len(piece)] = tags
    return x, y


def train(docs: DataFrame, key: str = "doc_id", text: str = "text",
          sample: int = SAMPLE_DOCS, spans: int = SAMPLE_SPANS) -> dict[str, np.ndarray]:
    """A tagger from a bounded sample: the surroundings of the first `spans` base spans, or
    of the middle where there are none, of the documents whose keys have the smallest codes,
    `sample` surroundings in all."""
    n = docs.count()
    share = min(1.0, 4 * sample / max(n, 1))
    code = F.xxhash64(F.col(key))
    rows = (docs.where(F.col(text).isNotNull())
            # The codes are spread evenly, so this share of them is this share of rows.
            .where(F.pmod(code, F.lit(1_000_000)) < F.lit(int(np.ceil(share * 1_000_000))))
            .select(code.alias("code"), F.col(text).alias("text"))
            .mapInArrow(_surroundings(spans), "code long, text string")
            .orderBy("code", "text").limit(sample).collect())
    x, y = windows_of([r["text"] for r in rows])
    return learn(x, y)


def _surroundings(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, pieces = [], []
            for code, text in zip(batch.column("code").to_pylist(),
                                  batch.column("text").to_pylist()):
                spans = base_spans(text)[:most] or [(0, len(text) // 2, len(text) // 2)]
                for _, a, b in spans:
                    codes.append(code)
                    pieces.append(text[max(0, a - 160):b + 160])
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes, pa.int64()), pa.array(pieces, pa.string())],
                names=["code", "text"])

    return run


# --- decoding --------------------------------------------------------------------------
_MARGIN = 0.0


def plausible(kind: int, said: str, before: str, after: str) -> bool:
    """What an added span must look like: whole words of the right make."""
    if before and (before.isalnum() or before in "@_") or after and (after.isalnum() or after == "@"):
        return False
    digits = sum("0" <= c <= "9" for c in said)
    if kind == 0:
        name, at, host = said.replace("[@]", "@").replace(" @ ", "@").partition("@")
        return bool(at and name and set(name) <= LOCAL and _DOMAIN.fullmatch(host))
    if set(said) - set("0123456789 ().-+/:"):
        return False
    if kind == 1:
        host = re.split("[:/]", said)[0].split(".")
        return len(host) == 4 and all(p.isdigit() and len(p) <= 3 and int(p) <= 255 for p in host)
    if kind == 2:
        return 14 <= digits <= 19 and luhn(_NOT_DIGIT.sub("", said))
    return 10 <= digits <= 15 and len(re.findall("[0-9]+", said)) >= 3


def windows_around(flags: np.ndarray) -> list[tuple[int, int]]:
    """Windows in which every flagged character has MARGIN others, or the end of the text, on
    either side. They depend on what stands between the flags, not on where that begins."""
    at, out, i = np.flatnonzero(flags), [], 0
    while i < len(at):
        begin = max(0, int(at[i]) - MARGIN)
        i = int(np.searchsorted(at, max(int(at[i]) + 1, begin + STRETCH - MARGIN)))
        out.append((begin, min(len(flags), int(at[i - 1]) + MARGIN + 1)))
    return out


Piece = tuple[int, int, int, float, bool, bool]


def pieces_of(path: np.ndarray, margin: np.ndarray, begin: int, end: int,
              size: int) -> list[Piece]:
    """(kind, start, end, score, cut before, cut behind) of the tags of a window begin..end
    of a text of `size` characters."""
    out, t, n = [], 0, end - begin
    while t < n:
        tag = int(path[t])
        # An inside tag begins a piece only where the window cuts off what is before.
        if tag == 0 or tag % 2 == 0 and t > 0:
            t += 1
            continue
        kind, stop = (tag - 1) // 2, t + 1
        while stop < n and path[stop] == 2 + 2 * kind:
            stop += 1
        if tag % 2 or begin > 0:
            out.append((kind, begin + t, begin + stop, float(margin[t:stop].mean()),
                        t == 0 and begin > 0, stop == n and end < size))
        t = stop
    return out


def joined(pieces: list[Piece]) -> list[tuple]:
    """Spans of the pieces of one text: those no edge cuts, and those made of pieces that
    overlap where edges cut them."""
    out = [p[:4] for p in pieces if not (p[4] or p[5])]
    going: dict[int, Piece] = {}
    for p in sorted((p for p in pieces if p[4] or p[5]), key=lambda p: (p[1], p[2])):
        kind, a, b, score, before, behind = p
        have = going.get(kind)
        if before:
            if have is None or a > have[2]:
                continue
            n, m = have[2] - have[1], b - a
            p = (kind, have[1], max(b, have[2]), (have[3] * n + score * m) / (n + m), False, behind)
        if behind:
            going[kind] = p
        elif before:
            out.append(p[:4])
            del going[kind]
    return out


def added_spans(p, chars: tx.Characters, texts: list[str | None]) -> list[list[tuple]]:
    """(kind, start, end, score) that the tagger finds in each text of a block."""
    x = classes(chars.points)
    flag = (x == _DIGIT) | (x == 7 + _SINGLE.index("@"))
    pieces: list[list[Piece]] = [[] for _ in texts]
    hit = np.unique(np.searchsorted(chars.limits, np.flatnonzero(flag), side="right") - 1)
    windows = [(i, a, b) for i in hit.tolist()
               for a, b in windows_around(flag[chars.limits[i]:chars.limits[i + 1]])]
    # Windows of about one length are decoded together.
    windows.sort(key=lambda w: w[2] - w[1])
    for at in range(0, len(windows), TOGETHER):
        own, begin, end = (np.array(c) for c in zip(*windows[at:at + TOGETHER]))
        length = end - begin
        place = (chars.limits[own] + begin)[:, None] + np.arange(length.max())
        inside = np.arange(length.max()) < length[:, None]
        w = np.where(inside, x[np.minimum(place, len(x) - 1)], _PAD).T
        tags, margin = best_paths(p, emissions(p, w))
        tags = np.where(inside.T, tags, 0)
        for j in np.flatnonzero(tags.any(axis=0)).tolist():
            i = int(own[j])
            pieces[i] += pieces_of(tags[:, j], margin[:, j], int(begin[j]), int(end[j]),
                                   int(chars.limits[i + 1] - chars.limits[i]))
    return [joined(own) for own in pieces]


def reconcile(text: str, base: list[Span], more: list[tuple]) -> list[Span]:
    """Base spans and the added ones that overlap neither them nor a better one."""
    taken = sorted((a, b) for _, a, b in base)
    spans = list(base)
    for kind, a, b, score in sorted(set(more), key=lambda s: (-s[3], s[1], s[2], s[0])):
        while a < b and text[a].isspace():
            a += 1
        while b > a and (text[b - 1].isspace() or text[b - 1] in ".,:;"):
            b -= 1
        if score < _MARGIN or a >= b or any(x < b and a < y for x, y in taken):
            continue
        if plausible(kind, text[a:b], text[a - 1:a], text[b:b + 1]):
            spans.append((kind, a, b))
            taken.append((a, b))
    return sorted(spans, key=lambda s: (s[1], s[0], s[2]))


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, done = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return "".join(out) + text[done:]


def _digest(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _find(p, kept: list[str], text: str, clean: bool, prefix: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in tx.blocks(batch, text):
                texts = [t or "" for t in batch.column(text).slice(
                    block.first, block.n).to_pylist()]
                more = added_spans(p, tx.characters(block), texts)
                base = [base_spans(t) for t in texts]
                full = [reconcile(t, b, m) for t, b, m in zip(texts, base, more)]
                null = block.null.tolist()
                count = [pa.array([sum(s[0] == k for s in b) for b in base], pa.int64())
                         for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(block.first, block.n) for c in kept), *count,
                    pa.array([_digest(b) for b in base], pa.string()),
                    pa.array([_digest(f) for f in full], pa.string()),
                    pa.array([None if gone or not clean else redact(t, f)
                              for t, f, gone in zip(texts, full, null)], pa.string())],
                    names=[*kept, *(prefix + c for c in FOUND)])

    return run


FOUND = (*(f"n_{k}" for k in KINDS), "base", "spans", "clean")


def find(docs: DataFrame, network: dict[str, np.ndarray], keep: list[str], text: str = "text",
         clean: bool = True, prefix: str = "") -> DataFrame:
    """The columns `keep` with counts of base spans, `base` and `spans` as lists of
    kind:start:end, and `clean`, the text with all spans replaced; `prefix` goes before
    the names of these."""
    if {prefix + c for c in FOUND} & set(keep):
        raise ValueError("the rows already have columns of these names; give a prefix")
    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
    kinds += [f"`{prefix}{c}` {'long' if c.startswith('n_') else 'string'}" for c in FOUND]
    name, columns = tx.text_column(keep, text)
    return docs.select(*columns).mapInArrow(_find(network, keep, name, clean, prefix),
                                            ", ".join(kinds))
