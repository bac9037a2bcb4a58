"""Toxicity: Levenshtein automata on a lexicon trie, scored by context."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlens.llm.common import id_remainder, small_batches, stored

WORD = re.compile(r"[^\W_]+")
#: Matches remembered by a Python worker, and states of the automaton.
CACHED_WORDS, CACHED_STATES = 150_000, 25_000
# Words that report speech, and signs that open and close a quotation.
REPORTING = frozenset("said says say saying called calls wrote writes quoted quote quotes term word words slur "
                      "dit disait appelle mot écrit sagte sagt nennt wort schrieb dijo dice llama palabra escribió".split())
OPENING, CLOSING = "“„«‹", "”»›"


@dataclass(frozen=True)
class Toxicity:
    """Parameters.

    The classifier is fitted on at most ``train`` labelled documents (those of
    lowest id hash), which also bounds the terms.  A term is a word, or the
    first 4 to 6 letters of words (a stem).  Every term enters whose documents
    are toxic by ``precision`` and more surely than chance among all terms.
    Misspellings: one edit from ``one_edit`` letters on, two from ``two_edits``.
    A quotation reaches ``reach`` words after a reporting word.
    """

    train: int = 20_000
    precision: float = 0.6
    one_edit: int = 5
    two_edits: int = 9
    reach: int = 4
    threshold: float = 0.3
    modulus: int = 4
    held: int = 2


class LexiconAutomaton:
    """All words near a term: the lexicon's trie crossed with Levenshtein automata.

    A state is the set of ``(trie node, edits)`` pairs that a prefix can have
    reached, closed under skipping a letter of the term; it is built when first
    met, so a word costs one step a letter.  With ``first`` edits may fall on
    any letter, as the operator has it; without it the first must be right.
    A stem matches every word that begins with it, without edits.
    """

    def __init__(self, terms: list[str], one_edit: int = 5, two_edits: int = 9, first: bool = False):
        self.terms = terms
        self.one, self.two, self.first = one_edit, two_edits, first
        self.next: list[dict[str, int]] = [{}]
        self.term_at: dict[int, int] = {}
        self.stem_at: dict[int, int] = {}
        self.allowed = [0]  # most edits of any term below the node
        for i, term in enumerate(terms):
            stem = term.endswith("*")
            node = 0
            if first and not stem:
                self.allowed[0] = max(self.allowed[0], self._edits(len(term)))
            for ch in term.rstrip("*"):
                if ch not in self.next[node]:
                    self.next[node][ch] = len(self.next)
                    self.next.append({})
                    self.allowed.append(0)
                node = self.next[node][ch]
                if not stem:
                    self.allowed[node] = max(self.allowed[node], self._edits(len(term)))
            (self.stem_at if stem else self.term_at)[node] = i
        self.clear()

    def _edits(self, length: int) -> int:
        return 2 if length >= self.two else 1 if length >= self.one else 0

    def clear(self) -> None:
        start = self._closed({0: 0}) if self.first else {0: 0}
        self.states: list[dict[int, int]] = [start]
        self.number = {frozenset(start.items()): 0}
        self.moves: dict[tuple[int, str], int] = {}

    def _closed(self, reached: dict[int, int]) -> dict[int, int]:
        """Adds what skipping letters of the term reaches."""
        todo = list(reached.items())
        while todo:
            node, e = todo.pop()
            if reached.get(node, 9) < e:
                continue
            for child in self.next[node].values():
                if e < self.allowed[child] and e + 1 < reached.get(child, 9):
                    reached[child] = e + 1
                    todo.append((child, e + 1))
        return reached

    def _move(self, state: int, ch: str) -> int:
        reached: dict[int, int] = {}

        def put(node: int, e: int) -> None:
            if e < reached.get(node, 9):
                reached[node] = e

        for node, e in self.states[state].items():
            if node == 0 and not self.first:
                if ch in self.next[0]:
                    put(self.next[0][ch], 0)
                continue
            for letter, child in self.next[node].items():
                if letter == ch:
                    put(child, e)
                elif e < self.allowed[child]:
                    put(child, e + 1)  # another letter
            if e < self.allowed[node]:
                put(node, e + 1)  # a letter too many
        reached = self._closed(reached)
        key = frozenset(reached.items())
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(reached)
        self.moves[state, ch] = self.number[key]
        return self.number[key]

    def match(self, word: str) -> tuple[int, int] | None:
        """``(term, edits)`` of the nearest term (the longest stem before a misspelling), or None."""
        if len(self.states) > CACHED_STATES:
            self.clear()
        state, node, stem = 0, 0, None
        for ch in word:
            if node is not None:
                node = self.next[node].get(ch)
                if node in self.stem_at:
                    stem = self.stem_at[node]
            state = self.moves[state, ch] if (state, ch) in self.moves else self._move(state, ch)
            if not self.states[state] and node is None:
                break
        best = None
        for at, e in self.states[state].items():
            term = self.term_at.get(at)
            if term is not None and e <= self._edits(len(self.terms[term])) and (best is None or (e, term) < best):
                best = (e, term)
        if best is not None and best[0] == 0:
            return best[1], 0
        if stem is not None:
            return stem, 0
        return None if best is None else (best[1], best[0])


@dataclass
class Lexicon:
    """Terms with their strength (share of toxic documents); ordinary words are never misspellings."""

    terms: list[str]
    strength: list[float]
    ordinary: frozenset = frozenset()
    params: Toxicity = field(default_factory=Toxicity)

    def __post_init__(self):
        self.automaton = LexiconAutomaton(self.terms, self.params.one_edit, self.params.two_edits, first=True)
        self.known: dict[str, tuple[int, int] | None] = {}

    def __reduce__(self):
        return Lexicon, (self.terms, self.strength, self.ordinary, self.params)

    def find(self, word: str) -> tuple[int, int] | None:
        if word in self.known:
            return self.known[word]
        hit = self.automaton.match(word)
        if hit is not None and hit[1] and word in self.ordinary:
            hit = None
        if len(self.known) < CACHED_WORDS:
            self.known[word] = hit
        return hit

    def features(self, text: str | None) -> tuple[float, float, float, float, float]:
        """Sums of strengths: exact, misspelled, quoted; then their density and the length."""
        low = (text or "").lower()
        words = WORD.findall(low)
        find = self.find
        hits = [(i, h) for i, h in enumerate(map(find, words)) if h is not None] if self.terms else []
        if not hits:
            return 0.0, 0.0, 0.0, 0.0, math.log1p(len(words))
        quoted = _quoted(low, words, [i for i, _ in hits], self.params.reach)
        sums = [0.0, 0.0, 0.0]
        for (_, (term, edits)), q in zip(hits, quoted):
            sums[2 if q else 1 if edits else 0] += self.strength[term] * (0.5 if edits else 1.0)
        return (math.log1p(sums[0]), math.log1p(sums[1]), math.log1p(sums[2]),
                math.log1p(100 * (sums[0] + sums[1]) / len(words)), math.log1p(len(words)))


def _quoted(text: str, words: list[str], at: list[int], reach: int) -> list[bool]:
    """Whether each of the word positions stands in a quotation or follows a reporting word closely."""
    spans = [m.span() for m in WORD.finditer(text)]
    marks = [(m.start(), m[0]) for m in re.finditer(r'["“”„«»‹›]', text)]
    # whether a plain or a closing sign stands at this mark or later
    ends = [(False, False)]
    for _, sign in reversed(marks):
        ends.append((ends[-1][0] or sign == '"', ends[-1][1] or sign in CLOSING))
    ends.reverse()
    inside, depth, plain, k = [], 0, False, 0
    for i in at:
        while k < len(marks) and marks[k][0] < spans[i][0]:
            sign = marks[k][1]
            if sign == '"':
                plain = not plain
            elif sign in OPENING:
                depth += 1
            else:
                depth = max(0, depth - 1)
            k += 1
        # an opening sign that is never closed opens nothing
        closed = plain and ends[k][0] or depth > 0 and ends[k][1]
        inside.append(closed
                      or any(w in REPORTING for w in words[max(0, i - reach):i]))
    return inside


# ----------------------------------------------------------------- fitting
def _term_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for text, toxic in zip(f["text"], f["toxic"]):
            words = set(WORD.findall((text or "").lower()))
            stems = {w[:k] + "*" for w in words for k in (4, 5, 6) if len(w) > k}
            seen[int(toxic)].update(words | stems)
        terms = list(seen[0].keys() | seen[1].keys())
        yield pd.DataFrame({"term": terms, "toxic": [seen[1][t] for t in terms], "clean": [seen[0][t] for t in terms]})


def _near_words(lexicon: Lexicon):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            hits = [lexicon.automaton.match(t) for t in f["term"]]
            yield f.loc[np.array([h is not None and h[1] > 0 for h in hits], dtype=bool), ["term"]]
    return run


def _feature_rows(lexicon):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lex = lexicon.value
        for f in frames:
            rows = [lex.features(t) for t in f["text"]]
            yield pd.DataFrame(rows, columns=["x0", "x1", "x2", "x3", "x4"]).assign(toxic=f["toxic"].to_numpy())
    return run


def fit_logistic(x: np.ndarray, y: np.ndarray, prior: np.ndarray, penalty: float = 1.0) -> np.ndarray:
    """Logistic weights (bias first) by Newton steps, drawn towards ``prior`` (the bias is free)."""
    a = np.column_stack([np.ones(len(x)), x])
    p = np.concatenate([[0.0], prior])
    pull = np.full(a.shape[1], penalty)
    pull[0] = 1e-3
    w = p.copy()
    w[0] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for _ in range(50):
        m = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (m * (1 - m))[:, None]).T @ a + np.diag(pull), a.T @ (y - m) - pull * (w - p))
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


#: What the weights are drawn to: exact, misspelled, quoted, density, length.
PRIOR = np.array([4.0, 4.0, 0.5, 0.5, 0.0])


@dataclass
class Model:
    lexicon: Lexicon
    weights: list[float]

    def score(self, text: str | None) -> float:
        z = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], self.lexicon.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def fit(docs: DataFrame, labels: DataFrame, params: Toxicity = Toxicity(), id_col: str = "doc_id",
        text_col: str = "text", label_col: str = "toxic") -> Model:
    """The lexicon and the weights, from labelled documents that are not held out.

    At most ``params.train`` labelled ids are drawn by hash and broadcast;
    their texts are counted with partial aggregates.  Labels that are null or
    lack an id are left out; of repeated labels the largest counts.  Without
    toxic training documents the lexicon is empty and the score is the base
    rate.
    """
    p = params
    spark = docs.sparkSession
    small_batches(spark)
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
             .where(id_remainder(F.col(id_col), p.modulus) != p.held)
             .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("toxic"))
             .orderBy(F.xxhash64("_id"), "_id").limit(p.train))
    train = stored(docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("text"))
                   .join(F.broadcast(known), "_id"), "labelled")
    total, toxic = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not toxic:
        rate = 0.5 / (total + 2)
        return Model(Lexicon([], [], frozenset(), p), [math.log(rate / (1 - rate)), 0, 0, 0, 0, 0])
    terms = stored(train.select("text", "toxic").mapInPandas(_term_counts, "term string, toxic long, clean long")
                   .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "terms")
    share = min(max(toxic / total, 1e-6), 0.999)
    df = F.col("toxic") + F.col("clean")
    gain = 2 * (F.col("toxic") * F.log(F.col("toxic") / (df * share))
                + F.when(F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (df * (1 - share)))).otherwise(0.0))
    sure = 2 * (math.log(max(terms.count(), 2)) + 2)
    best = (terms.where((F.col("toxic") >= 3) & (F.col("toxic") >= p.precision * df))
            .withColumn("gain", gain).where(F.col("gain") >= sure)
            .orderBy(F.desc("gain"), "term").toPandas())
    lexicon = Lexicon(best["term"].tolist(), ((best["toxic"] + 0.5) / (best["toxic"] + best["clean"] + 1)).tolist(),
                      frozenset(), p)
    # words of clean documents that stand near a term are words of their own
    near = (terms.where((F.col("clean") > 0) & ~F.col("term").endswith("*")).select("term", "clean")
            .mapInPandas(_near_words(lexicon), "term string").toPandas())
    lexicon = Lexicon(lexicon.terms, lexicon.strength, frozenset(near["term"]), p)
    sent = spark.sparkContext.broadcast(lexicon)
    rows = train.select("text", "toxic").mapInPandas(
        _feature_rows(sent), "x0 double, x1 double, x2 double, x3 double, x4 double, toxic int").toPandas()
    rows = rows.sort_values(list(rows.columns))
    w = fit_logistic(rows[["x0", "x1", "x2", "x3", "x4"]].to_numpy(), rows["toxic"].to_numpy(np.float64), PRIOR)
    return Model(lexicon, w.tolist())


def _scores(model):
    """The model as a column function of the text; nothing else goes to Python."""
    def scores(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = model.value
        for t in texts:
            yield pd.Series([m.score(x) for x in t], dtype="float64")
    return F.pandas_udf(scores, "double")


def score_toxicity(docs: DataFrame, labels: DataFrame, params: Toxicity = Toxicity(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """``id_col, held_out, score, predicted`` of every document, from its text alone.

    Rows whose ``crc32(id as text) mod params.modulus`` is ``params.held`` never
    train.  Defined cases: null and empty texts score as texts without words; a
    null id is never held out and never labelled; rows that repeat an id are
    scored one by one; other columns play no part; an empty table gives an
    empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, params, id_col, text_col))
    held = F.coalesce(id_remainder(F.col(id_col), params.modulus) == params.held, F.lit(False))
    out = docs.select(F.col(id_col).cast("long").alias(id_col), held.alias("held_out"),
                      _scores(sent)(F.col(text_col)).alias("score"))
    return out.select("*", (F.col("score") >= params.threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, params: Toxicity = Toxicity(), id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, params, id_col, text_col))
    return docs.where(_scores(sent)(F.col(text_col)) < params.threshold)
