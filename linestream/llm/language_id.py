"""Language ID: script ranges, per-word scores, Viterbi over languages.

Learning counts the words of labelled rows per language inside each task and
sums hashed character trigrams over the cluster; the model is a table of
`TABLE` hashed trigrams by languages and a script-by-language table, so its
size depends on the number of languages only.

Predicting: a text is cut into words at script borders, the word's script
leaves the languages that were learned with it, each word gets a log score per
remaining language (cached by word), and a Viterbi pass with a penalty for
each switch labels spans. The passes of a batch run in step, shortest text
dropped first. The language with the most letters wins; the score is its share
of letters.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_or_empty

#: Slots for hashed character trigrams.
TABLE = 1 << 16
#: Cost (natural log) of a change of language between two words.
SWITCH = 6.0
#: A language keeps a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.01
#: Words a Python worker keeps scores for; distinct words a task counts before it emits.
WORD_CACHE = 500_000
#: Log score of a trigram in a text of no language at all: all slots alike.
BACKGROUND = -float(np.log(TABLE))
#: A text without letters, or null.
UNKNOWN = "und"

#: Scripts by Unicode ranges (public block charts); letters elsewhere are "other".
SCRIPTS = {
    "latin": "A-Za-zªºÀ-ÖØ-öø-ɏḀ-ỿ",
    "greek": "Ͱ-Ͽἀ-῿",
    "cyrillic": "Ѐ-ԯᲀ-᲏ⷠ-ⷿ",
    "armenian": "԰-֏",
    "hebrew": "֐-׿",
    "arabic": "؀-ۿݐ-ݿࢠ-ࣿ",
    "devanagari": "ऀ-ॿ",
    "bengali": "ঀ-৿",
    "tamil": "஀-௿",
    "thai": "฀-๿",
    "georgian": "Ⴀ-ჿ",
    "hangul": "ᄀ-ᇿ㄰-㆏가-힯",
    "kana": "぀-ヿ",
    "han": "㐀-䶿一-鿿\U00020000-\U0002fa1f",
}
SCRIPT_NAMES = [*SCRIPTS, "other"]
_LETTER = r"[^\W\d_]"
#: A word: letters (and the marks inside the block) of one script.
WORDS = re.compile("|".join(f"(?=[{r}]){_LETTER}[{r}]*" for r in SCRIPTS.values())
                   + "|" + f"(?:(?![{''.join(SCRIPTS.values())}]){_LETTER})+")
#: In a text without any other characters, words are plain runs of letters.
_PLAIN_TEXT = re.compile("[\x00-\x7fÀ-ɏ¡¿«»–—‘’“”…]*")
_PLAIN_WORDS = re.compile(f"{_LETTER}+")
_SCRIPT_OF = [(i, re.compile(f"[{r}]")) for i, r in enumerate(SCRIPTS.values())]


@lru_cache(maxsize=4096)
def script_of_char(c: str) -> int:
    return next((i for i, p in _SCRIPT_OF if p.match(c)), len(SCRIPT_NAMES) - 1)


def words_of(text: str) -> list[str]:
    text = text.lower()
    return (_PLAIN_WORDS if _PLAIN_TEXT.fullmatch(text) else WORDS).findall(text)


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character trigrams of the words with their borders, one after the
    other, and where each word's begin (a word has as many as letters)."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    code = np.frombuffer(("\2" + "\3\2".join(words) + "\3").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    h = code[:-2] * np.uint64(0x9E3779B97F4A7C15) + code[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + code[2:] * np.uint64(0x165667B19E3779F9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    inside = np.ones(len(code), bool)
    ends = np.cumsum(size + 2)
    inside[ends - 1] = inside[ends - 2] = False
    return (h >> np.uint64(40))[inside[:-2]].astype(np.int64) % TABLE, np.cumsum(size) - size


# ---------------------------------------------------------------- learning


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words per language in this task, reduced to trigram and script counts."""
    seen: dict[str, Counter] = {}
    slots: dict[str, np.ndarray] = {}  # slots from TABLE on are scripts

    def fold() -> None:
        for lang, counter in seen.items():
            words = list(counter)
            n = np.fromiter(counter.values(), np.int64, len(words))
            size = np.fromiter(map(len, words), np.int64, len(words))
            total = slots.setdefault(lang, np.zeros(TABLE + len(SCRIPT_NAMES), np.int64))
            total[:TABLE] += np.bincount(trigrams(words)[0], weights=np.repeat(n, size), minlength=TABLE).astype(np.int64)
            script = np.fromiter((script_of_char(w[0]) for w in words), np.int64, len(words))
            total[TABLE:] += np.bincount(script, weights=n * size, minlength=len(SCRIPT_NAMES)).astype(np.int64)
        seen.clear()

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if words := words_of(text):
                seen.setdefault(lang, Counter()).update(words)
        if sum(map(len, seen.values())) > WORD_CACHE:
            fold()
    fold()
    for lang, total in slots.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()),
                                          pa.array(total[at], pa.int64())], names=["lang", "slot", "n"])


def learn(train: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict | None:
    """Model from all labelled rows (null language or text: not used).

    Its size is bounded by languages x (TABLE + scripts), the rows collected.
    None if there is nothing to learn from.
    """
    rows = train.where(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{text_col}`").isNotNull())
    rows = rows.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), text_or_empty(text_col).alias("text"))
    counts = (rows.mapInArrow(_count, "lang string, slot int, n long")
              .groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas())
    if counts.empty:
        return None
    langs = sorted(counts["lang"].unique())
    grid = np.zeros((len(langs), TABLE + len(SCRIPT_NAMES)))
    grid[[langs.index(x) for x in counts["lang"]], counts["slot"].to_numpy()] = counts["n"].to_numpy()
    grams, scripts = grid[:, :TABLE], grid[:, TABLE:]
    logs = np.log((grams + 0.1) / (grams.sum(1, keepdims=True) + 0.1 * TABLE))
    allowed = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(1, keepdims=True), 1)
    allowed[:, ~allowed.any(0)] = True  # a script nobody was learned with narrows nothing
    return {"langs": langs, "logs": np.ascontiguousarray(logs.T.astype(np.float32)), "allowed": allowed.T,
            "typical": (np.exp(logs) * logs).sum(1) - BACKGROUND}


# ---------------------------------------------------------------- predicting

#: Log score of a language that the script rules out.
_OUT = -1000.0


class Scorer:
    """Per-word scores with a bounded cache: word -> row of `table`."""

    def __init__(self, model: dict):
        self.model, self.k = model, len(model["langs"])
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, self.k), np.float32)
        self.best = np.zeros(1024, np.float32)  # log score of a word in its best language, over the background
        self.size = np.zeros(1024, np.int32)

    def _scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        slots, starts = trigrams(words)
        s = np.add.reduceat(self.model["logs"][slots], starts, axis=0)
        ok = self.model["allowed"][np.fromiter((script_of_char(w[0]) for w in words), np.int64, len(words))]
        best = np.where(ok, s, -np.inf).max(1, keepdims=True)
        s = s - best
        # one word never outweighs a span: its evidence is held to twice a switch
        return np.where(ok, np.maximum(s, -2 * SWITCH), _OUT), best[:, 0]

    def numbers(self, words: list[str]) -> np.ndarray:
        rows = self.rows
        new = list(set(words).difference(rows))
        if new:
            first, last = len(rows), len(rows) + len(new)
            while last > len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.best = np.concatenate([self.best, np.zeros_like(self.best)])
                self.size = np.concatenate([self.size, np.zeros_like(self.size)])
            self.size[first:last] = np.fromiter(map(len, new), np.int32, len(new))
            self.table[first:last], best = self._scores(new)
            self.best[first:last] = best - BACKGROUND * self.size[first:last]
            rows.update(zip(new, range(first, last), strict=True))
        return np.fromiter(map(rows.__getitem__, words), np.int32, len(words))

    def trim(self) -> None:
        if len(self.rows) > WORD_CACHE:
            self.rows.clear()


def one_language(scores: np.ndarray, switch: float = SWITCH) -> int | None:
    """The language of a text whose best path never switches, if that can be
    told at once: no run of words favours another language by more than half
    of what a switch costs (m runs in other languages need m - 1 switches)."""
    best = int(scores.sum(0).argmax())
    lead = np.cumsum(scores - scores[:, best:best + 1], axis=0, dtype=np.float64)
    low = np.minimum(np.minimum.accumulate(np.vstack([np.zeros((1, lead.shape[1])), lead[:-1]]), axis=0), 0)
    return best if (lead - low).max() <= switch / 2 else None


def viterbi(texts: list[np.ndarray], table: np.ndarray, switch: float = SWITCH) -> list[np.ndarray]:
    """Best language of every word of every text (texts: rows of `table`).

    All texts of the batch advance together; a text leaves when its words end.
    """
    order = sorted(range(len(texts)), key=lambda i: -len(texts[i]))
    longest, k = (len(texts[order[0]]) if order else 0), table.shape[1]
    live = np.searchsorted(-np.array([len(texts[i]) for i in order]), -np.arange(longest), side="left")
    starts = np.concatenate([[0], np.cumsum(live)])
    flat = np.empty(int(starts[-1]), np.int32)  # words by position, then by text
    for rank, i in enumerate(order):
        flat[starts[:len(texts[i])] + rank] = texts[i]
    back = np.empty((len(flat), k), np.uint16 if k > 255 else np.uint8)
    best = np.zeros((len(order), k), np.float32)
    own = np.arange(k)
    last = np.zeros(len(order), np.int64)
    for t in range(longest):
        n = live[t]
        b = best[:n]
        top = b.argmax(1)
        jump = np.take_along_axis(b, top[:, None], 1) - switch
        stay = b >= jump
        at = slice(starts[t], starts[t + 1])
        back[at] = np.where(stay, own, top[:, None])
        b = np.where(stay, b, jump) + table[flat[at]]
        best[:n] = b - b.max(1, keepdims=True)
        ends = live[t + 1] if t + 1 < longest else 0
        last[ends:n] = best[ends:n].argmax(1)
    state = last.copy()
    labels = np.empty(len(flat), back.dtype)
    for t in range(longest - 1, -1, -1):
        n = live[t]
        at = slice(starts[t], starts[t + 1])
        labels[at] = state[:n]
        state[:n] = np.take_along_axis(back[at], state[:n, None].astype(np.int64), 1)[:, 0]
    out: list = [None] * len(texts)
    for rank, i in enumerate(order):
        out[i] = labels[starts[:len(texts[i])] + rank]
    return out


#: Words whose paths are followed at once (one very long text may hold more alone).
WORDS_AT_ONCE = 2_000_000

_scorers: dict = {}


def _labelled(model_of, batches: Iterator[pa.RecordBatch], finish, schema: list[tuple[str, pa.DataType]]):
    """Label the words of each text; `finish` turns (text, labels) into values."""
    model = model_of.value
    scorer = _scorers.get(id(model_of.value))
    if scorer is None:
        _scorers.clear()
        scorer = _scorers[id(model_of.value)] = Scorer(model)
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1).to_pylist()
        values: list = [None] * len(texts)
        held: list[tuple[int, np.ndarray]] = []
        size = 0

        def work() -> None:
            one = [one_language(scorer.table[r]) for _, r in held]
            paths = iter(viterbi([r for (_, r), lang in zip(held, one, strict=True) if lang is None], scorer.table))
            for (i, rows), lang in zip(held, one, strict=True):
                labels = next(paths).astype(np.int64) if lang is None else np.full(len(rows), lang)
                over = scorer.best[rows] + np.maximum(scorer.table[rows, labels], -2 * SWITCH)
                values[i] = finish(texts[i], labels, scorer.size[rows], model, over)
            held.clear()
            scorer.trim()

        for i, text in enumerate(texts):
            words = words_of(text) if text else []
            if not words:
                values[i] = finish(text, np.zeros(0, np.int64), np.zeros(0, np.int32), model, np.zeros(0))
                continue
            held.append((i, scorer.numbers(words)))
            size += len(words)
            if size >= WORDS_AT_ONCE or len(scorer.rows) > WORD_CACHE:
                work()
                size = 0
        work()
        cols = [pa.array([v[j] for v in values], t) for j, (_, t) in enumerate(schema)]
        yield pa.RecordBatch.from_arrays([ids, *cols], names=["key", *(n for n, _ in schema)])


def _verdict(text, labels: np.ndarray, sizes: np.ndarray, model: dict, over: np.ndarray) -> tuple:
    langs = model["langs"]
    if not len(labels):
        return UNKNOWN, 0.0, 0, 0.0
    letters = np.bincount(labels, weights=sizes, minlength=len(langs))
    best = int(letters.argmax())
    # what the text's letters are over the background, to what text of these languages is on average
    typical = float((letters * model["typical"]).sum())
    evidence = float(over.sum()) / typical if typical > 0 else 0.0
    return langs[best], float(letters[best] / letters.sum()), 1 + int((labels[1:] != labels[:-1]).sum()), evidence


def _spans(text: str | None, labels: np.ndarray, sizes: np.ndarray, model: dict, over: np.ndarray) -> tuple:
    langs = model["langs"]
    spans = []
    lower = (text or "").lower()
    for i, m in enumerate((_PLAIN_WORDS if _PLAIN_TEXT.fullmatch(lower) else WORDS).finditer(lower)):
        lang = langs[labels[i]]
        if spans and spans[-1]["lang"] == lang:
            spans[-1]["end"] = m.end()
        else:
            spans.append({"lang": lang, "start": m.start(), "end": m.end()})
    return (spans,)


def _run(docs: DataFrame, model: dict, key: Column, key_type, text_col: str, finish,
         fields: list[tuple[str, pa.DataType]], schema: str) -> DataFrame:
    schema = T.StructType([T.StructField("key", T.DataType.fromDDL(key_type) if isinstance(key_type, str) else key_type),
                           *T.StructType.fromDDL(schema)])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(key.alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(lambda batches: _labelled(shared, batches, finish, fields), schema)


def predict(docs: DataFrame, model: dict | None, key: Column, key_type: str | T.DataType = "long",
            text_col: str = "text") -> DataFrame:
    """key, lang_pred, score, n_spans, evidence of every row (a key may be a whole row).

    The evidence is the log score of the text's letters, in the languages they
    are labelled with, over that of a text of no language; 1 is what text of
    those languages has on average, 0 or less is junk or another language.

    `und` with score 0 if the text is null or has no letter, or if nothing was
    learned. A text in a script nobody was learned with still gets the learned
    language with the closest trigrams. Ties go to the first language name.
    """
    if model is None:
        return docs.select(key.alias("key"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(0).cast("long").alias("n_spans"), F.lit(0.0).alias("evidence"))
    fields = [("lang_pred", pa.string()), ("score", pa.float64()), ("n_spans", pa.int64()), ("evidence", pa.float64())]
    return _run(docs, model, key, key_type, text_col, _verdict, fields, "lang_pred string, score double, n_spans long, evidence double")


def label_spans(docs: DataFrame, model: dict, key: Column, key_type: str | T.DataType = "long",
                text_col: str = "text") -> DataFrame:
    """key, spans: the spans of one language each (lang, start, end in code
    points of the lower-cased text), in text order; empty if there is no letter."""
    kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return _run(docs, model, key, key_type, text_col, _spans, [("spans", kind)],
                "spans array<struct<lang:string,start:long,end:long>>")


# ---------------------------------------------------------------- the query's split

#: Rows whose crc32(id as text) leaves this remainder are held out of learning.
FOLDS, HELD_OUT = 4, 2


def held_out(id_col: str = "doc_id") -> Column:
    """A null id has no number and is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, n_spans; learned from the labelled
    rows that are not held out (a null id is not held out). One row per input
    row; repeated rows give repeated results; extra columns are not read."""
    model = learn(docs.where(~held_out(id_col)), lang_col, text_col)
    out = predict(docs, model, F.col(f"`{id_col}`").cast("long"), "long", text_col)
    return out.select(F.col("key").alias("doc_id"), held_out("key").alias("held_out"), "lang_pred", "score", "n_spans")
