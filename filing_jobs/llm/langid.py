"""Language identification by word-first backoff.

A known word scores by its log frequency in each language. An unseen word falls back to character
n-grams of the padded word: at every position the longest known n-gram that ends there counts. (A
penalty for each step to a shorter one would be the same for all languages.) The document's language
is the one with the greatest sum. What a language never had counts the same for all languages, less
than anything that one of them had, so little text is no advantage. A document's score is how much more
probable its words are in its language than in all others pooled, which many small languages hardly change.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filing_jobs.llm.common import id_remainder, picked

ORDERS = (5, 4, 3, 2, 1)
WORD = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
#: Words kept in a task's memo (it only saves time) and words looked up at a time; both less where languages are many.
MEMO, PART = 700_000, 50_000
#: Numbers that a memo may hold: two for each word and language.
CELLS = 8 * MEMO


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters; empty for null and for texts without a letter."""
    found = WORD.findall(text.lower()) if text else []
    return found if any(any(map(str.isalpha, w)) for w in found) else []


@dataclass
class LanguageModel:
    """Log frequencies by language. ``words`` and ``grams`` give a key's row; only the languages that have it are held.

    ``first`` has where each row's entries begin, ``lang`` their languages, ``gain`` the log frequency above the floor
    and ``less`` what the pooled count loses without that language. ``pooled`` and ``order`` are those of a row;
    ``floors`` and ``sums`` of an order: log frequency of what a language never had, and log of the others' counts.
    """

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    first: np.ndarray
    lang: np.ndarray
    gain: np.ndarray
    less: np.ndarray
    pooled: np.ndarray
    order: np.ndarray
    floors: np.ndarray
    sums: np.ndarray
    memo: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.rows = np.zeros((16, 2 * len(self.languages)))
        most = CELLS // max(1, 2 * len(self.languages))
        self.most, self.part = min(MEMO, max(4, most)), min(PART, max(2, most // 8))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("memo", "rows")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__ |= state | {"memo": {}}
        self.__post_init__()

    def keys_of(self, word: str) -> list[int]:
        """The rows of a known word, or of the longest known n-gram that ends at each of its places."""
        if (at := self.words.get(word)) is not None:
            return [at]
        padded, found, grams = f"^{word}$", [], self.grams.get
        for end in range(1, len(padded) + 1):
            for n in ORDERS:
                if n <= end and (gram := grams(padded[end - n : end])) is not None:
                    found.append(gram)
                    break
        return found

    def learn(self, words: list[str]) -> None:
        """Put each word into the memo: its log frequency in each language above the floor, and how it compares with the others'."""
        k, n = len(self.languages), len(words)
        keys = [self.keys_of(w) for w in words]
        row = np.array([x for found in keys for x in found], np.int64)
        word = np.repeat(np.arange(n), [len(found) for found in keys])
        size = self.first[row + 1] - self.first[row]
        entry = np.repeat(self.first[row] - np.concatenate([[0], size.cumsum()[:-1]]) if len(row) else row, size) + np.arange(size.sum())
        cell = np.repeat(word, size) * k + self.lang[entry]
        gain = np.bincount(cell, self.gain[entry], n * k).reshape(n, k)
        orders = np.bincount(word * len(self.floors) + self.order[row], minlength=n * len(self.floors)).reshape(n, -1)
        others = np.bincount(word, self.pooled[row], n)[:, None] - orders @ self.sums - np.bincount(cell, self.less[entry], n * k).reshape(n, k)
        ahead = gain + (orders @ self.floors)[:, None] - others
        share = 1 / (1 + np.exp(-np.clip(ahead, -700, 700)))
        at = len(self.memo)
        while len(self.rows) < at + n:
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[at : at + n] = np.hstack([gain, share])
        self.memo.update(zip(words, range(at, at + n), strict=True))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language and the mean over the text's words of the share p / (p + q), p being the word's probability in it and q
        in the others; ``und`` and 0 without letters or without a model."""
        words, k = words_of(text), len(self.languages)
        if not words or not k:
            return UNKNOWN, 0.0
        total = np.zeros(2 * k)
        for start in range(0, len(words), self.part):
            part = words[start : start + self.part]
            at = list(map(self.memo.get, part))
            if None in at:
                if len(self.memo) + len(part) > self.most:  # start anew: frequent words come back at once
                    self.memo.clear()
                self.learn([w for w in dict.fromkeys(part) if w not in self.memo])
                at = list(map(self.memo.get, part))
            total += self.rows[at].sum(axis=0)
        best = int(total[:k].argmax())
        return self.languages[best], float(min(1.0, max(0.0, total[k + best] / len(words))))


def fit(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        max_docs_per_language: int = 400, max_chars_per_language: int = 8_000_000, max_chars: int = 64_000_000, most_languages: int = 1000,
        max_languages: int | None = None, min_count: int = 2) -> LanguageModel:
    """Learn from the rows with a non-null language, whole texts.

    The classifier is fitted on a bounded sample: of each language about ``max_docs_per_language`` rows, fewer
    if they had more than about ``max_chars_per_language`` characters together, or than the language's equal part
    of ``max_chars``, chosen by a hash of the id, so the model that goes to the executors is bounded too. Of more
    than ``most_languages`` values of the label the most frequent are learned (ties: in order of the value), the
    others are never predicted; more than ``max_languages``, where it is given, are an error. Rows without text or
    language teach nothing; no rows, no languages.
    """
    rows = picked(df, i=id_col, t=text_col, lang=lang_col).where("lang is not null and t is not null")
    counts = rows.groupBy("lang").agg(F.count("*").alias("rows"), F.sum(F.length("t")).alias("chars"))
    sizes = counts.orderBy(F.desc("rows"), "lang").limit(max(most_languages, max_languages or 0) + 1).collect()
    if max_languages is not None and len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    sizes = sizes[:most_languages]
    if not sizes:
        nothing = np.zeros(0)
        return LanguageModel([], {}, {}, np.zeros(1, np.int64), np.zeros(0, np.int64), nothing, nothing, nothing, np.zeros(0, np.int64), nothing, np.zeros((0, 0)))
    languages = sorted(r["lang"] for r in sizes)
    chars = min(max_chars_per_language, max_chars // len(sizes))
    shares = [(r["lang"], int((1 << 20) * min(1.0, max_docs_per_language / r["rows"], chars / max(1, r["chars"])))) for r in sizes]
    shares = df.sparkSession.createDataFrame([(lang, max(1, x)) for lang, x in shares], "lang string, share long")  # at most most_languages rows
    chosen = rows.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64(F.coalesce(F.col("i").cast("string"), F.lit(""))), F.lit(1 << 20)) < F.col("share"))

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int], Counter] = {}
        for batch in batches:
            for text, lang in zip(batch["t"].to_pylist(), batch["lang"].to_pylist(), strict=True):
                for word, n in Counter(words_of(text)).items():
                    counts.setdefault((lang, 0), Counter())[word] += n
        for (lang, _), words in list(counts.items()):
            for word, c in words.items():
                padded = f"^{word}$"
                for n in ORDERS:
                    of = counts.setdefault((lang, n), Counter())
                    for at in range(len(padded) - n + 1):
                        of[padded[at : at + n]] += c
        for (lang, n), found in counts.items():
            yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(found), pa.string()), "n": pa.array([n] * len(found), pa.int32()), "gram": pa.array(list(found), pa.string()), "c": pa.array(list(found.values()), pa.int64())})

    counted = chosen.select("t", "lang").mapInArrow(grams, "lang string, n int, gram string, c long").groupBy("n", "gram", "lang").agg(F.sum("c").alias("c"))
    found = counted.where((F.col("n") > 0) | (F.col("c") >= min_count)).toArrow()
    at = {lang: i for i, lang in enumerate(languages)}
    lang = np.array([at[x] for x in found["lang"].to_pylist()], int)
    order, c = found["n"].to_numpy(), found["c"].to_numpy().astype(float)
    keys: dict[int, dict[str, int]] = {n: {} for n in (0, *ORDERS)}
    place = np.fromiter((keys[n].setdefault(g, len(keys[n])) for n, g in zip(order.tolist(), found["gram"].to_pylist(), strict=True)), int, len(c))
    starts = dict(zip(keys, np.cumsum([0, *(len(x) for x in keys.values())])[:-1].tolist(), strict=True))
    row = place + np.array([starts.get(n, 0) for n in range(max(ORDERS) + 1)])[order]
    n_rows, k = sum(map(len, keys.values())), len(languages)
    pooled = np.bincount(row, c, n_rows)
    row_order = np.concatenate([np.full(len(x), i) for i, x in enumerate(keys.values())]).astype(np.int64)
    slot = np.array([list(keys).index(n) for n in range(max(ORDERS) + 1)])[order]
    mass = np.bincount(slot * k + lang, c, len(keys) * k).reshape(len(keys), k)
    known = np.bincount(slot * k + lang, minlength=len(keys) * k).reshape(len(keys), k)
    total = mass + 0.5 * known + 1  # half an occurrence more of each key that a language has
    floors = np.log(0.5) - np.log(total.max(axis=1))
    alone = np.bincount(row, minlength=n_rows)[row] == 1  # keys that no other language has
    others = np.array([[len(x)] for x in keys.values()]) - np.bincount(slot * k + lang, alone, len(keys) * k).reshape(len(keys), k)
    sums = np.log(mass.sum(axis=1, keepdims=True) - mass + 0.5 * others + 1)
    by_row = np.argsort(row, kind="stable")
    gain = np.log(c + 0.5) - np.log(total[slot, lang]) - floors[slot]
    without = np.where(alone, sums[slot, lang] + floors[slot], np.log(pooled[row] - c + 0.5))  # what the others never had counts as the floor
    less = np.log(pooled[row] + 0.5) - without
    words = {g: starts[0] + i for g, i in keys[0].items()}
    rows = {g: starts[n] + i for n in ORDERS for g, i in keys[n].items()}
    first = np.concatenate([[0], np.bincount(row, minlength=n_rows).cumsum()]).astype(np.int64)
    return LanguageModel(languages, words, rows, first, lang[by_row].astype(np.int64), gain[by_row], less[by_row], np.log(pooled + 0.5), row_order, floors, sums)


def predict(df: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row, from the text alone.

    Null, empty and letterless texts give ``und`` and 0. Repeated rows each get their row. The model
    (bounded, see ``fit``) is broadcast.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            langs, scores = zip(*map(own.predict, batch["t"].to_pylist()), strict=True) if batch.num_rows else ((), ())
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"])

    rows = picked(df, id=id_col, t=text_col)
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def held_out(id_col: str = "doc_id"):
    """The rows that teach nothing: crc32 of the id as text is divisible by 5."""
    return id_remainder(id_col, 5) == 0


def keep_identified(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_score: float = 0.3) -> DataFrame:
    """The rows of ``df`` whose text is in a language: those predicted ``und`` or with less than ``min_score`` go.

    The model is fitted on ``df`` itself (rows that are not held out); all columns of ``df`` stay as they are.
    If nothing can be learned from ``df``, every text with letters stays. A text that is as probable in the other
    languages together as in its own scores 0.5, however many languages there are; ``min_score`` 0.3 asks for odds of 3 to 7.
    """
    model = fit(df.where(~held_out(id_col)), id_col=id_col, text_col=text_col, lang_col=lang_col)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("boolean")
    def identified(texts):
        import pandas as pd

        own = shared.value
        if not own.languages:
            return pd.Series([bool(words_of(t)) for t in texts], dtype=bool)
        found = (own.predict(t) for t in texts)
        return pd.Series([lang != UNKNOWN and score >= min_score for lang, score in found], dtype=bool)

    return df.where(identified(F.col(f"`{text_col}`")))
