"""Toxicity of texts by a fuzzy lexicon with context windows.

The lexicon is learned from labelled rows: words and word stems that stand in toxic texts
and hardly in others. Its trie is intersected with Levenshtein automata: a state is a set
of (trie node, edits so far), worked out lazily and kept as a table, so a word is read once,
whatever the size of the lexicon. Edits are changed, lost, added and swapped letters, the
first letter's too, and digits or marks in place of letters. Exact and misspelled matches
may go on (inflected forms). What a kind of match is worth is learned, and kinds that are
worth nothing are left out. Words that several clean labelled texts have are words of their
own, no misspellings; words of a single one stand for those not seen yet and hold the
weights of misspellings down.

Each match is looked at in a window of words: in quotation marks or behind a reporting
word it counts as quoted, near a form of address or another match as abuse. A logistic
model over these sums gives the score. Weights, both of terms by number of edits and of
the context, come from the labelled rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.quality import labelled_sample
from tidemark.llm.text import ChunkCache, slices_at_space

LABEL_ROWS = 20_000  # labelled rows that everything here is fitted on
STEM_CHARS = (3, 10)
LEAST_ROWS = 5  # toxic rows that must hold a term
LEAST_LOG_ODDS = 3.0
WINDOW = 6

# Words of address and of reporting in the languages of the corpora: fixed values.
ADDRESS = frozenset("you your yours yourself u ur du dein deine dich dir ihr euch tu toi ton ta vous votre te ti tú usted ustedes vosotros".split())
REPORTING = frozenset("said says say called calls wrote writes quote quoted quoting term word sagte sagt schrieb nannte wort zitat dit écrit appelé mot citation dijo dice escribió llamó palabra cita".split())
_QUOTES = "\"“”„«»‘’'"
_LETTERS = re.compile(r"[^\W\d_]+")
_AROUND = re.compile(r"^[^\w]+|[^\w]+$")


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class FuzzyLexicon:
    """Levenshtein automata over the trie of ``terms``; :meth:`match` gives (term number,
    edits) of the best match of a word, or None: fewest edits, then the longest term."""

    STATES = 100_000

    def __init__(self, terms: list[str]):
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.end: list[int] = [-1]
        self.reach = [0]
        for number, term in enumerate(terms):
            node = 0
            for c in term:
                self.reach[node] = max(self.reach[node], edits_allowed(term))
                nxt = self.children[node].get(c)
                if nxt is None:
                    nxt = self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.end.append(-1)
                    self.reach.append(0)
                node = nxt
            self.reach[node] = max(self.reach[node], edits_allowed(term))
            self.end[node] = number
        self.reset()

    def reset(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.inside: list[tuple[int, int] | None] = []  # exact matches, which may go on
        self.final: list[tuple[int, int] | None] = []  # any match that ends here
        self.dead = self.state(frozenset())
        # a misspelling keeps the first letter: a word starts in its letter's state
        self.starts = {c: self.state(self.close({(n, 0)})) for c, n in self.children[0].items()}

    def state(self, members: frozenset) -> int:
        number = self.numbers.get(members)
        if number is None:
            number = self.numbers[members] = len(self.sets)
            self.sets.append(members)
            self.steps.append({})
            ends = [(e, -len(self.terms[t]), t) for n, e in members if (t := self.end[n]) >= 0 and e <= edits_allowed(self.terms[t])]
            self.final.append((min(ends)[2], min(ends)[0]) if ends else None)
            exact = [x for x in ends if x[0] == 0]
            self.inside.append((min(exact)[2], 0) if exact else None)
        return number

    def close(self, pairs: set[tuple[int, int]]) -> frozenset:
        """With what left-out letters lead to, less what can't match any more."""
        best: dict[int, int] = {}
        work = list(pairs)
        while work:
            n, e = work.pop()
            if e > self.reach[n] or best.get(n, 9) <= e:
                continue
            best[n] = e
            work += [(c, e + 1) for c in self.children[n].values()]
        return frozenset(best.items())

    def step(self, state: int, char: str) -> int:
        out: set[tuple[int, int]] = set()
        for n, e in self.sets[state]:
            out.add((n, e + 1))  # a letter too many
            for c, child in self.children[n].items():
                out.add((child, e if c == char else e + 1))
        nxt = self.steps[state][char] = self.state(self.close(out))
        return nxt

    def match(self, word: str) -> tuple[int, int] | None:
        s = self.starts.get(word[0])
        if s is None:
            return None
        if len(self.sets) > self.STATES:
            self.reset()
            s = self.starts[word[0]]
        steps, inside, dead, best = self.steps, self.inside, self.dead, self.inside[s]
        for c in word[1:]:
            nxt = steps[s].get(c)
            s = self.step(s, c) if nxt is None else nxt
            if s == dead:
                return best
            best = inside[s] or best
        return best or self.final[s]


KINDS = 5  # of matches: exact; of the whole word with one and two edits; of its beginning with one and two edits


class WholeLexicon(FuzzyLexicon):
    """As :class:`FuzzyLexicon`, with edits anywhere in every term (a swap of neighbours is
    one edit) and misspelled beginnings. :meth:`match` gives (term number, kind): the
    smallest kind, then the longest term. ``without`` holds codes (term * KINDS + kind + 1)
    that are no match."""

    def __init__(self, terms: list[str], without: frozenset[int] = frozenset()):
        self.without = without
        super().__init__(terms)
        self.reach = [0] * len(self.children)
        for term in terms:
            node, allowed = 0, self.allowed(term)
            self.reach[0] = max(self.reach[0], allowed)
            for c in term:
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], allowed)
        self.reset()

    @staticmethod
    def allowed(term: str) -> int:
        return 1 if len(term) < 9 else 2

    def reset(self) -> None:
        self.numbers, self.sets, self.steps, self.inside, self.final = {}, [], [], [], []
        self.dead = self.state(frozenset())
        self.start = self.state(self.close({(0, 0, "")}))

    def state(self, members: frozenset) -> int:
        """Members are (node, edits, the letter of a swap that must come next to get there)."""
        number = self.numbers.get(members)
        if number is None:
            number = self.numbers[members] = len(self.sets)
            self.sets.append(members)
            self.steps.append({})
            ends = [(e, -len(self.terms[t]), t) for n, e, due in members if not due and (t := self.end[n]) >= 0 and e <= self.allowed(self.terms[t])]
            for kinds, begun in ((self.final, 0), (self.inside, 2)):
                found = [(kind, length, t) for e, length, t in ends if t * KINDS + (kind := e + begun * (e > 0)) + 1 not in self.without]
                kinds.append(min(found) if found else None)
        return number

    def close(self, pairs: set) -> frozenset:
        best: dict[tuple[int, str], int] = {}
        work = list(pairs)
        while work:
            n, e, due = work.pop()
            if e > self.reach[n] or best.get((n, due), 9) <= e:
                continue
            best[n, due] = e
            if not due:
                work += [(c, e + 1, "") for c in self.children[n].values()]
        return frozenset((n, e, due) for (n, due), e in best.items())

    def step(self, state: int, char: str) -> int:
        out = set()
        for n, e, due in self.sets[state]:
            if due:
                if due == char:
                    out.add((n, e, ""))
                continue
            out.add((n, e + 1, ""))
            for c, child in self.children[n].items():
                out.add((child, e if c == char else e + 1, ""))
                if c != char and char in self.children[child]:
                    out.add((self.children[child][char], e + 1, c))
        nxt = self.steps[state][char] = self.state(self.close(out))
        return nxt

    def match(self, word: str) -> tuple[int, int] | None:
        if len(self.sets) > self.STATES:
            self.reset()
        s, best = self.start, None
        for i, c in enumerate(word):
            nxt = self.steps[s].get(c)
            s = self.step(s, c) if nxt is None else nxt
            if s == self.dead:
                break
            found = (self.inside if i + 1 < len(word) else self.final)[s]
            if found and (best is None or found < best):
                best = found
        return (best[2], best[0]) if best else None


def spelled(chunk: str) -> list[str]:
    """The words of a chunk; with letters on both sides of digits or marks, or digits or
    marks at an end, also the whole chunk less the marks around it."""
    words = words_of(chunk)
    whole = _AROUND.sub("", chunk.lower())
    return words if not words or words == [whole] else [*words, whole]


def words_of(chunk: str) -> list[str]:
    lower = chunk.lower()
    return [lower] if lower.isalpha() else _LETTERS.findall(lower)


class Reader:
    """Matches of a text with their context. A code is term * KINDS + kind + 1; 0 is no match."""

    ADDRESSED, REPORTED, OPENS, CLOSES = 1, 2, 4, 8

    def __init__(self, lexicon: FuzzyLexicon, known: frozenset[str] = frozenset()):
        self.lexicon, self.known = lexicon, known
        self.chunks = ChunkCache(self.chunk, limit=600_000)

    def chunk(self, chunk: str) -> bytes:
        code, flags = 0, 0
        for w in spelled(chunk):
            m = self.lexicon.match(w)
            if m and m[1] and w in self.known:
                m = None
            if m and (not code or m[1] < (code - 1) % KINDS):
                code = m[0] * KINDS + m[1] + 1
            flags |= self.ADDRESSED * (w in ADDRESS) | self.REPORTED * (w in REPORTING)
        if chunk[0] in _QUOTES:
            flags |= self.OPENS
        if chunk[-1] in _QUOTES or chunk.rstrip(".,;:!?")[-1:] in tuple(_QUOTES):
            flags |= self.CLOSES
        return (code | flags << 16).to_bytes(4, "little")

    def read(self, text: str | None) -> dict:
        """Distinct codes of the matches that aren't quoted, how often each is there, and the
        codes that are quoted only; matches near a form of address and near another match; matches and words in all."""
        out = {"plain": [], "times": [], "quoted": [], "addressed": 0, "clustered": 0, "hits": 0, "words": 0}
        if not text:
            return out
        get = self.chunks.__getitem__
        x = np.frombuffer(b"".join(b"".join(map(get, p.split())) for p in slices_at_space(text)), "<u4")
        codes, flags = x & 0xFFFF, x >> 16
        at = np.flatnonzero(codes)
        out["words"], out["hits"] = len(x), len(at)
        plain, quoted = Counter(), set()
        for i in at.tolist():
            lo, hi = max(0, i - WINDOW), i + WINDOW + 1
            near = flags[lo:hi]
            opened = np.flatnonzero(flags[lo:i + 1] & self.OPENS)
            inside = len(opened) and not (flags[lo + opened[-1]:i] & self.CLOSES).any() and (flags[i:hi] & self.CLOSES).any()
            if inside or (flags[lo:i] & self.REPORTED).any():
                quoted.add(int(codes[i]))
                continue
            plain[int(codes[i])] += 1
            out["addressed"] += bool((near & self.ADDRESSED).any())
            out["clustered"] += np.count_nonzero(codes[lo:hi]) > 1
        out["plain"], out["quoted"] = sorted(plain), sorted(quoted - plain.keys())
        out["times"] = [plain[c] for c in out["plain"]]
        return out


class Model:
    def __init__(self, terms: list[str], weights: np.ndarray, coef: np.ndarray, known: frozenset[str] = frozenset()):
        self.terms, self.weights, self.coef, self.known = terms, weights, coef, known

    def score(self, found: dict) -> float:
        z = float(features(found, self.weights) @ self.coef)
        return 1.0 / (1.0 + float(np.exp(-np.clip(z, -30, 30))))


def features(found: dict, weights: np.ndarray) -> np.ndarray:
    plain = sum(weights[c] for c in found["plain"])
    again = sum(weights[c] * np.log(n) for c, n in zip(found["plain"], found["times"], strict=True))
    quoted = sum(weights[c] for c in found["quoted"])
    some = plain > 0
    return np.array([1.0, np.log1p(plain + 0.25 * quoted), plain >= LEAST_LOG_ODDS, np.log1p(again),
                     np.log1p(100.0 * sum(found["times"]) / max(found["words"], 1)) * some,
                     np.log1p(found["addressed"]) * some, np.log1p(found["clustered"]) * some])


def pick_terms(rows: list[tuple[str, int, float]]) -> list[str]:
    """Of candidate stems (stem, toxic rows, log odds) those that say it once: the longest
    form that keeps 95 % of the rows of the shorter one, none below a taken stem."""
    by = {s: (n, w) for s, n, w in rows}
    longer: dict[str, list[str]] = {}
    for s in by:
        longer.setdefault(s[:-1], []).append(s)
    taken: list[str] = []
    for s in sorted(by, key=lambda s: (len(s), s)):
        if any(s.startswith(t) or t.startswith(s) for t in taken if t[:1] == s[:1]):
            continue
        at = s
        while True:
            nxt = [t for t in longer.get(at, []) if by[t][0] >= 0.95 * by[s][0]]
            if not nxt:
                break
            at = nxt[0]
        taken.append(at)
    return sorted(taken)


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABEL_ROWS) -> Model:
    """A model from at most ``rows`` labelled rows (``labels``: doc_id, toxic), none of them
    held out. Without toxic or without clean rows the lexicon is empty."""
    train = labelled_sample(labels.filter(~held_out(F.col("doc_id"))), "toxic", rows).checkpoint()
    texts = docs.select(F.col("doc_id").cast("long").alias("label_id"), F.col("text").cast("string").alias("text"))
    known = texts.join(F.broadcast(train), "label_id").select("text", "label")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        n = [0, 0]

        def batch() -> pa.RecordBatch:
            words = list(seen[0].keys() | seen[1].keys())
            cols = [["", *words], [n[1], *(seen[1][w] for w in words)], [n[0], *(seen[0][w] for w in words)]]
            n[:] = [0, 0]
            for s in seen:
                s.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["word", "toxic", "clean"])

        for b in batches:
            for text, label in zip(b.column("text"), b.column("label").to_pylist(), strict=True):
                which = int(label == 1)
                n[which] += 1
                seen[which].update({w for p in slices_at_space(text.as_py() or "") for w in words_of(p) if len(w) >= STEM_CHARS[0]})
                if len(seen[0]) + len(seen[1]) > 400_000:
                    yield batch()
        yield batch()

    words = known.mapInArrow(count, "word string, toxic long, clean long").groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).checkpoint()
    # the empty word has the numbers of rows; every stem adds up its words
    stems = words.select(F.explode(F.when(F.col("word") == "", F.array(F.lit(""))).otherwise(F.transform(
        F.sequence(F.lit(STEM_CHARS[0]), F.least(F.char_length("word"), F.lit(STEM_CHARS[1]))),
        lambda k: F.substring("word", F.lit(1), k)))).alias("stem"), "toxic", "clean")
    sums = stems.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(F.col("toxic") >= 1).checkpoint()
    total = sums.filter("stem = ''").first()
    n_toxic, n_clean = (int(total["toxic"]), int(total["clean"])) if total else (0, 0)
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    found = []
    if n_toxic and n_clean:
        found = (sums.filter(F.col("stem") != "").withColumn("w", odds).filter((F.col("toxic") >= LEAST_ROWS) & (F.col("w") >= LEAST_LOG_ODDS))
                 .collect())  # words of at most ``rows`` labelled rows
    terms = pick_terms(sorted(((r["stem"], r["toxic"], r["w"]) for r in found), key=lambda t: (-t[1] * t[2], t[0])))
    if not terms:
        return Model([], np.zeros(1), np.array([-5.0, 0, 0, 0, 0, 0, 0]))

    def misspelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = WholeLexicon(terms)
        for b in batches:
            yield b.filter(pa.array([bool((m := lexicon.match(w)) and m[1]) for w in b.column("word").to_pylist()], pa.bool_()))

    own = words.filter((F.col("word") != "") & (F.col("clean") >= 2) & (F.col("clean") * n_toxic >= F.col("toxic") * n_clean))
    known = frozenset(r["word"] for r in own.select("word").mapInArrow(misspelt, "word string").collect())

    def read_rows(without: frozenset[int]) -> list[dict]:
        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            reader = Reader(WholeLexicon(terms, without), known)
            for b in batches:
                out = [reader.read(t.as_py()) for t in b.column("text")]
                yield pa.RecordBatch.from_arrays(
                    [b.column("label_id"), b.column("label"), *(pa.array([o[k] for o in out], pa.list_(pa.int64())) for k in ("plain", "times", "quoted")),
                     *(pa.array([int(o[k]) for o in out], pa.int64()) for k in ("addressed", "clustered", "hits", "words"))],
                    names=["label_id", "label", "plain", "times", "quoted", "addressed", "clustered", "hits", "words"])

        seen = (texts.join(F.broadcast(train), "label_id").select("text", "label_id", "label")
                .mapInArrow(read, "label_id long, label int, plain array<long>, times array<long>, quoted array<long>, addressed long, clustered long, hits long, words long"))
        one = seen.groupBy("label_id").agg(F.min(F.struct("label", "plain", "times", "quoted", "addressed", "clustered", "hits", "words")).alias("r")).select("r.*")
        return [r.asDict() for r in one.orderBy("label", "plain", "times", "words", "hits", "addressed", "clustered").collect()]

    weights = _term_weights(terms, read_rows(frozenset()))
    without = _worthless(weights)
    rows_read = read_rows(without)  # a word may match another way where a kind is left out
    weights = np.where(weights > 0, _term_weights(terms, rows_read), 0.0)
    return _weigh(terms, weights, rows_read, known)


def _worthless(weights: np.ndarray) -> frozenset[int]:
    return frozenset(np.flatnonzero(weights == 0).tolist()) - {0}


def _term_weights(terms: list[str], rows: list[dict]) -> np.ndarray:
    """Weights of terms by kind of match, from at most ``LABEL_ROWS`` rows."""
    n = np.zeros((2, KINDS * len(terms) + 1))
    for r in rows:
        for c in {*r["plain"], *r["quoted"]}:
            n[int(r["label"] == 1), c] += 1
    toxic = sum(r["label"] == 1 for r in rows)
    w = np.log((n[1] + 0.5) / (toxic + 1.0)) - np.log((n[0] + 0.5) / (len(rows) - toxic + 1.0))
    if rows:  # a misspelling's smoothing is by the share of toxic rows: a few clean rows alone give it no weight
        share = max(toxic, 1) / len(rows)
        w2 = np.log((n[1] + 0.5 * share) / (toxic + 0.5 * share)) - np.log((n[0] + 0.5 * (1 - share) + 1e-9) / (len(rows) - toxic + 0.5 * (1 - share) + 1e-9))
        w = np.where((np.arange(len(w)) - 1) % KINDS == 0, w, np.minimum(w, w2))
    weights = np.where(n.sum(axis=0) > 0, np.maximum(w, 0.0), 0.0)
    for t in range(len(terms)):  # a misspelling that no labelled row has: as its term, halved by each edit and by going on
        for kind, halves in ((1, 1), (2, 2), (3, 2), (4, 3)):
            if not n[:, KINDS * t + 1 + kind].any():
                weights[KINDS * t + 1 + kind] = weights[KINDS * t + 1] * 0.5 ** halves
    return weights


def _weigh(terms: list[str], weights: np.ndarray, rows: list[dict], known: frozenset[str]) -> Model:
    """Weights of the context, from at most ``LABEL_ROWS`` rows."""
    x = np.array([features(r, weights) for r in rows])
    y = np.array([float(r["label"] == 1) for r in rows])
    coef = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [1e-2] * (x.shape[1] - 1)) * len(y) / 100
    for _ in range(25):  # Newton steps
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ coef)
        coef = coef + step
        if np.abs(step).max() < 1e-9:
            break
    return Model(terms, weights, coef, known)


def held_out(doc_id: Column) -> Column:
    """Rows whose labels nothing may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 5 == 0, F.lit(False))


def score_toxicity(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted, hits, quoted`` for every row of ``docs``
    (``doc_id``, ``text``), scored by ``model`` or by one fitted on ``labels``.

    The text alone decides. Null and empty texts have no match and so the score of such
    texts. A null doc_id stays null and isn't held out; repeated rows are all returned; an
    empty table gives no rows. Labels with a null id or value don't count.
    """
    model = model or fit(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(WholeLexicon(model.terms, _worthless(model.weights)), model.known)
        for b in batches:
            found = [reader.read(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([model.score(f) for f in found], pa.float64()),
                 pa.array([f["hits"] for f in found], pa.int64()), pa.array([len(f["quoted"]) for f in found], pa.int64())],
                names=["doc_id", "score", "hits", "quoted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, hits long, quoted long").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits", "quoted")
