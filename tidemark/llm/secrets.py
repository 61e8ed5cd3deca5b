"""Secrets in texts, by fixed patterns and a linear-chain conditional random field.

The field tags tokens as begin, inside or outside of a secret. Its features are a token's
shape (kind of characters, length, variety), the shapes and words of the three tokens
before and of the one behind, and a feature of the whole file (how much of it isn't
prose). It is trained here on windows of a bounded sample, with the patterns' matches as
labels, and on copies of them in which a match is put in other words: under another name,
in other characters or shorter, so that no pattern matches it any more, or as a plain
setting that is no secret. So it finds secrets that the patterns miss.

Decoding is exact Viterbi. A token whose outside score leads by more than any change of
its transitions could make up is outside on the best path, so the path is worked out only
over the runs of tokens between such certain ones. Scores of distinct tokens are kept in a
table and gathered with array operations.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.text import ChunkCache, first_by_hash, slices_at_space

TRAIN_DOCS = 3000  # half of them with a match of a pattern, if there are so many
WINDOW = 40
STEPS, RATE, L2 = 120, 0.3, 0.002

# The patterns of the contract: fixed values. Group 2 of the first must have 8 characters.
ASSIGN = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "crf")
_CUES = ("password", "passwd", "secret", "token", "apikey", "api_key")
# For the sample only: texts that may have a match.
SAMPLE_CUE = r"AKIA[A-Z0-9]{12}|[0-9a-f]{32}|(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"

_TOKEN = re.compile(r"[\w+/-]+|[^\w\s+/-]+")
_CHUNK = re.compile(r"\S+")
_LONG = re.compile(r"\S{32,}")
OUT, BEGIN, INSIDE = 0, 1, 2
OFFSETS = (0, -3, -2, -1, 1)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches, by start, then kind as listed."""
    out = []
    lower = text.lower()
    if any(c in lower for c in _CUES):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m.group()) >= LEAST["access"]]
    for chunk in _LONG.finditer(text):  # a match has no white space
        out += [("hex", chunk.start() + m.start(), chunk.start() + m.end())
                for m in HEX.finditer(chunk.group()) if len(m.group()) >= LEAST["hex"]]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def value_spans(text: str) -> list[tuple[int, int]]:
    """Spans of the secret values themselves, for the labels."""
    out = []
    for kind, start, end in base_spans(text):
        if kind == "assign":
            start = end - len(ASSIGN.match(text, start).group(2))
        out.append((start, end))
    return out


def shape_of(token: str) -> str:
    n = len(token)
    size = sum(n > x for x in (3, 7, 11, 15, 23, 31, 47))
    if token.isalpha():
        return ("l" if token.islower() else "U" if token.isupper() else "T" if token[1:].islower() else "m") + str(size)
    if not any(c.isalnum() for c in token):
        return "p" + token[:2]
    chars = set(token)
    if chars <= set("0123456789"):
        kind = "d"
    elif chars <= set("0123456789abcdef"):
        kind = "x"
    elif token.isascii() and token.upper() == token:
        kind = "K"
    else:
        kind = "a" if any(c.isdigit() for c in token) else "s"
    return f"{kind}{size}v{min(3, len(chars) // 6)}"


def file_bucket(plain: int, total: int) -> int:
    """0 to 3 by the share of tokens that aren't plain words."""
    share = 1 - plain / max(total, 1)
    return sum(share > x for x in (0.15, 0.35, 0.6))


def tokens_of(text: str) -> Iterator[tuple[str, int]]:
    for c in _CHUNK.finditer(text):
        for m in _TOKEN.finditer(c.group()):
            yield m.group(), c.start() + m.start()


def described(token: str) -> tuple[str, str | None]:
    """What the field sees of a token: its shape and, for a word, the word. Both are short."""
    word = len(token) <= 48 and token.replace("_", "").replace("-", "").isalpha()
    return shape_of(token), token.lower() if word else None


# How secrets are put in other words for the training: names that no pattern has, ways to
# write them, and settings that are no secrets.
NAMES = ("passphrase", "credential", "private_key", "access_key", "auth", "pwd", "bearer", "client-key", "pin", "signature")
SETTINGS = ("version", "name", "count", "mode", "size", "path", "user", "date", "level", "id")
WRITTEN = ("{}={}", "{}: {}", '{} = "{}"', "{}='{}'", '"{}": "{}"')
_ALPHABETS = ("0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", "0123456789abcdef",
              "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def reworded(seed: int, secret: bool) -> tuple[str, int, int]:
    """A secret that the patterns don't match, or a setting: the text, and the span of the
    value (empty for a setting)."""
    rng = random.Random(seed)
    if not secret:
        value = rng.choice([str(rng.randrange(10_000)), f"{rng.randrange(20)}.{rng.randrange(20)}", rng.choice(("true", "none", "default", "main"))])
        return rng.choice(WRITTEN).format(rng.choice(SETTINGS), value), 0, 0
    value = "".join(rng.choices(rng.choice(_ALPHABETS), k=rng.randrange(12, 31)))
    text = rng.choice(WRITTEN).format(rng.choice(NAMES), value)
    at = text.index(value)
    return text, at, at + len(value)


def _tagged(toks: list[tuple[str, int]], values: list[tuple[int, int]]) -> tuple[list, list[int], list[int]]:
    """Tokens, tags, and the places where values begin."""
    tags = [OUT] * len(toks)
    starts = np.array([s for _, s in toks])
    ends = starts + np.array([len(t) for t, _ in toks])
    hits = []
    for a, b in values:
        i, j = int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left"))
        if i < j:
            tags[i:j] = [BEGIN] + [INSIDE] * (j - i - 1)
            hits.append(i)
    return toks, tags, hits


def training_windows(text: str, seed: int) -> list[tuple[list[tuple[str, str | None]], list[int], int]]:
    """At most four windows (described tokens, tags, file bucket): around a secret and one
    elsewhere; and the former twice more, with the match and its name put in other words
    and with a plain setting in its place."""
    toks = list(tokens_of(text))
    if not toks:
        return []
    bucket = file_bucket(sum(t.isalpha() for t, _ in toks), len(toks))
    toks, tags, hits = _tagged(toks, value_spans(text))

    def window(toks: list[tuple[str, int]], tags: list[int], at: int) -> tuple:
        return [described(t) for t, _ in toks[at:at + WINDOW]], tags[at:at + WINDOW], bucket

    out = [window(toks, tags, seed % len(toks))]
    if hits:
        out.append(window(toks, tags, max(0, hits[seed % len(hits)] - WINDOW // 2)))
        spans = base_spans(text)
        _, start, end = spans[seed % len(spans)]
        # enough text on both sides for a window, without other matches
        left = max([0, start - 400, *(e for _, _, e in spans if e <= start)])
        right = min([len(text), end + 400, *(s for _, s, _ in spans if s >= end)])
        for secret in (True, False):
            new, a, b = reworded(seed, secret)
            part, at = text[left:start] + new + text[end:right], start - left
            new_toks, new_tags, _ = _tagged(list(tokens_of(part)), [(at + a, at + b)] if secret else [])
            first = sum(p < at for _, p in new_toks)
            out.append(window(new_toks, new_tags, max(0, first - WINDOW // 2)))
    return out


class Field:
    """A trained field: weights per feature and label, transitions, and the words that have
    features of their own."""

    def __init__(self, weights: dict, transitions: np.ndarray, start: np.ndarray, words: frozenset):
        self.weights, self.transitions, self.start, self.words = weights, transitions, start, words

    def lead_needed(self) -> np.ndarray:
        """Per label: the outside lead above which a token is outside on the best path."""
        t = np.vstack([self.transitions, self.start])  # the last row: at the start
        into = (t - t[:, [OUT]]).max(axis=0)
        onward = np.maximum((self.transitions - self.transitions[[OUT]]).max(axis=1), 0.0)
        return into + onward


def _features(tokens: list[tuple[str, str | None]], bucket: int, words: frozenset) -> list[list]:
    shapes = [shape for shape, _ in tokens]
    named = [word if word in words else None for _, word in tokens]
    out = []
    for i in range(len(tokens)):
        f: list = [("file", bucket)]
        for o in OFFSETS:
            if 0 <= i + o < len(tokens):
                f.append((o, shapes[i + o]))
                if named[i + o]:
                    f.append((o, "w", named[i + o]))
        out.append(f)
    return out


def train(windows: list[tuple[list[tuple[str, str | None]], list[int], int]]) -> Field | None:
    """Maximum conditional likelihood by gradient ascent; None without any tagged token."""
    if not any(any(tags) for _, tags, _ in windows):
        return None
    near: Counter = Counter()
    for toks, tags, _ in windows:
        for i, tag in enumerate(tags):
            if tag == BEGIN:
                near.update({word for _, word in toks[max(0, i - 3):i] if word})
    words = frozenset(w for w, n in near.items() if n >= 3)
    feats = [_features(t, b, words) for t, _, b in windows]
    names = sorted({f for w in feats for t in w for f in t}, key=repr)
    index = {f: i + 1 for i, f in enumerate(names)}
    s, t, k = len(windows), WINDOW, 2 * len(OFFSETS) + 1
    x, y, length = np.zeros((s, t, k), np.int64), np.zeros((s, t), np.int64), np.array([len(w) for w in feats])
    for i, w in enumerate(feats):
        y[i, :len(w)] = windows[i][1]
        for j, fs in enumerate(w):
            x[i, j, :len(fs)] = [index[f] for f in fs]
    live = np.arange(t)[None, :] < length[:, None]
    weights, trans, start = np.zeros((len(names) + 1, 3)), np.zeros((3, 3)), np.zeros(3)
    seen = [np.zeros_like(a) + 1e-8 for a in (weights, trans, start)]
    flat = x.reshape(-1)

    def lse(a: np.ndarray, axis: int) -> np.ndarray:
        m = a.max(axis=axis, keepdims=True)
        return (m + np.log(np.exp(a - m).sum(axis=axis, keepdims=True))).squeeze(axis)

    for _ in range(STEPS):
        e = weights[x].sum(axis=2)
        alpha, beta = np.zeros((s, t, 3)), np.zeros((s, t, 3))
        alpha[:, 0] = e[:, 0] + start
        for j in range(1, t):
            step = lse(alpha[:, j - 1, :, None] + trans, 1) + e[:, j]
            alpha[:, j] = np.where(live[:, j, None], step, alpha[:, j - 1])
        for j in range(t - 2, -1, -1):
            step = lse(trans + (e[:, j + 1] + beta[:, j + 1])[:, None, :], 2)
            beta[:, j] = np.where(live[:, j + 1, None], step, 0.0)
        total = lse(alpha[:, -1], 1)
        post = np.exp(alpha + beta - total[:, None, None]) * live[:, :, None]
        diff = (np.eye(3)[y] - post) * live[:, :, None]
        g = np.stack([np.bincount(flat, np.repeat(diff[:, :, c].reshape(-1), k), len(names) + 1) for c in range(3)], axis=1) / s
        g[0] = 0
        pair = np.zeros((3, 3))
        for j in range(1, t):
            p = np.exp(alpha[:, j - 1, :, None] + trans + (e[:, j] + beta[:, j])[:, None, :] - total[:, None, None])
            pair -= (p * live[:, j, None, None]).sum(axis=0)
            np.add.at(pair, (y[:, j - 1][live[:, j]], y[:, j][live[:, j]]), 1)
        for a, grad, sq in zip((weights, trans, start), (g - L2 * weights / 10, pair / s - L2 * trans, diff[:, 0].sum(axis=0) / s - L2 * start), seen, strict=True):
            sq += grad * grad
            a += RATE * grad / np.sqrt(sq)
    return Field({f: weights[i] for f, i in index.items()}, trans, start, words)


class Tagger:
    """Decodes texts with a field, with a table of the scores of the tokens seen so far."""

    def __init__(self, field: Field, limit: int = 400_000):
        self.field, self.limit = field, limit
        self.need = field.lead_needed()
        self.shapes: dict[str, np.ndarray] = {}
        self.zero = np.zeros((len(OFFSETS), 3), np.float32)
        self.reset()

    def reset(self) -> None:
        self.codes: dict[str, int] = {}
        self.table = np.zeros((1024, len(OFFSETS), 3), np.float32)
        self.plain = np.zeros(1024, bool)
        self.chunks = ChunkCache(self.chunk_codes, limit=self.limit)

    def scores(self, token: str) -> np.ndarray:
        shape = shape_of(token)
        w = self.field.weights
        row = self.shapes.get(shape)
        if row is None:
            row = self.shapes[shape] = np.array([w.get((o, shape), np.zeros(3)) for o in OFFSETS], np.float32)
        if (word := token.lower()) in self.field.words:
            row = row + np.array([w.get((o, "w", word), np.zeros(3)) for o in OFFSETS], np.float32)
        return row

    def chunk_codes(self, chunk: str) -> bytes:
        out = []
        for token in _TOKEN.findall(chunk):
            code = self.codes.get(token)
            if code is None:
                code = len(self.codes)
                self.codes[token] = code
                if code == len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                    self.plain = np.concatenate([self.plain, np.zeros_like(self.plain)])
                self.table[code] = self.scores(token)
                self.plain[code] = token.isalpha()
            out.append(code)
        return np.array(out, np.int32).tobytes()

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Spans of the secrets on the best path."""
        if len(self.codes) > self.limit:
            self.reset()
        get = self.chunks.__getitem__
        codes = np.frombuffer(b"".join(b"".join(map(get, p.split())) for p in slices_at_space(text)), np.int32)
        n = len(codes)
        if not n:
            return []
        bucket = file_bucket(int(self.plain[codes].sum()), n)
        e = self.table[codes, 0] + np.asarray(self.field.weights.get(("file", bucket), np.zeros(3)), np.float32)
        for k, o in enumerate(OFFSETS[1:], 1):
            if n > abs(o):
                if o < 0:
                    e[-o:] += self.table[codes[:o], k]
                else:
                    e[:-o] += self.table[codes[o:], k]
        open_at = np.flatnonzero(((e[:, [OUT]] - e) <= self.need)[:, 1:].any(axis=1))
        if not len(open_at):
            return []
        first = open_at[np.concatenate(([True], np.diff(open_at) > 1))]
        last = open_at[np.concatenate((np.diff(open_at) > 1, [True]))]
        found = []
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            tags = self.best_path(e[a:b + 1].astype(np.float64), a == 0, b == n - 1)
            found += [(a + i, a + j) for i, j in _runs(tags)]
        if not found:
            return []
        places = [(s, s + len(t)) for t, s in tokens_of(text)]
        return [(places[i][0], places[j][1]) for i, j in found]

    def best_path(self, e: np.ndarray, at_start: bool, at_end: bool) -> list[int]:
        t = self.field.transitions
        v = e[0] + (self.field.start if at_start else t[OUT])
        back = []
        for row in e[1:]:
            m = v[:, None] + t
            back.append(m.argmax(axis=0))
            v = m.max(axis=0) + row
        tag = int((v if at_end else v + t[:, OUT]).argmax())
        path = [tag]
        for b in reversed(back):
            tag = int(b[tag])
            path.append(tag)
        return path[::-1]


def _runs(tags: list[int]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for i, tag in enumerate(tags):
        if tag == BEGIN or tag == INSIDE and (not out or out[-1][1] != i - 1):
            out.append([i, i])
        elif tag == INSIDE:
            out[-1][1] = i
    return [(a, b) for a, b in out]


def fit(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Field | None:
    """A field trained on windows of at most ``train_docs`` rows: those first by a hash of id
    and text, half of them among texts that may have a match. A secret in them that no
    pattern matches counts as outside, so such ones should be rarer than matches."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter("text is not null and text <> ''")
    rows = rows.withColumn("at", F.xxhash64("doc_id", "text"))
    chosen = first_by_hash(rows, F.col("at"), [(F.lit(True), train_docs - train_docs // 2), (F.col("text").rlike(SAMPLE_CUE), train_docs // 2)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [w for text, at in zip(b.column("text"), b.column("at").to_pylist(), strict=True)
                   for w in training_windows(text.as_py(), at)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([[s for s, _ in w[0]] for w in out], pa.list_(pa.string())), pa.array([[n for _, n in w[0]] for w in out], pa.list_(pa.string())),
                 pa.array([w[1] for w in out], pa.list_(pa.int64())), pa.array([w[2] for w in out], pa.int64())],
                names=["shapes", "words", "tags", "bucket"])

    found = chosen.select("text", "at").mapInArrow(run, "shapes array<string>, words array<string>, tags array<long>, bucket long")
    return train(sorted(((list(zip(r["shapes"], r["words"], strict=True)), list(r["tags"]), r["bucket"]) for r in found.collect()), key=repr))


def find_secrets(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """``doc_id, spans`` for every row of ``docs`` (``doc_id``, ``text``): all spans as
    ``array<struct<kind, start, end>>`` in code points, end exclusive, by start, then kind:
    the patterns' matches, and as kind ``crf`` those of the field (trained on ``docs`` if
    none is given) that overlap no match.

    A null or empty text has none. A null doc_id stays null, repeated rows are all
    returned, an empty table gives no rows. Without any match there is nothing to train
    on, and so no span of the field.
    """
    field = field or fit(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = Tagger(field) if field else None
        for b in batches:
            out = []
            for cell in b.column("text"):
                text = cell.as_py() or ""
                spans = base_spans(text)
                if tagger:
                    taken = [(s, e) for _, s, e in spans]
                    spans += [("crf", s, e) for s, e in tagger.spans(text) if not any(s < y and x < e for x, y in taken)]
                    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
                out.append([{"kind": k, "start": s, "end": e} for k, s, e in spans])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(out, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])))],
                names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def secret_report(docs: DataFrame) -> DataFrame:
    """The spans of :func:`find_secrets` as counts, a digest of the patterns' and text."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return find_secrets(docs).select("doc_id", count("assign"), count("access"), count("hex"),
                                     F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
