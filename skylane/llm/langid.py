"""Language ID by interpolated Kneser-Ney character models, one for each language.

A word is read as its lower-cased letters with three blanks before and one behind it;
characters beyond the basic plane are folded into it. The counts of runs of four characters
come from all labelled documents and are made in Spark, in proportion to the input; the
lower orders count in how many contexts a run was seen. Every run and context has a row of
its own, so the model grows with what the corpus holds. A model of up to ``COLLECTED`` runs
times languages is collected as sorted arrays beside one column for each language, and is
searched by halving in a column function; a larger one stays in Spark as tables, and the
distinct runs of the documents are joined with it. Both give the same shares.

The language of the lowest cross-entropy per character is chosen. The score is the share
of that language when all are weighted by exp(-sharpness * cross-entropy); the sharpness,
and the cross-entropy beyond which a text is rejected as foreign to all languages, are
calibrated on at most ``CALIBRATION`` of the labelled documents, chosen by the hash of
their ids. Null texts and texts without a letter are ``und`` with score 0, as is every
text when nothing could be learned. Of equal cross-entropies the first language in
alphabetical order wins.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylane.llm import rows

ORDER = 4
# Runs of four characters times languages up to which a model is collected.
COLLECTED = 2_000_000
CALIBRATION = 2000
CALIBRATION_CHARS = 20_000
SHARPNESS = (1, 2, 5, 10, 20, 50, 100, 200)
UNKNOWN = "und"
PREDICTION = "lang_pred string, score double, cross_entropy double, rejected boolean"



def _other_numbers() -> str:
    """Number forms and letter numbers, which a word character class takes for letters, as ranges."""
    codes = [c for c in range(0x80, 0x110000) if unicodedata.category(chr(c)) in ("Nl", "No")]
    starts = [c for c, before in zip(codes, [0, *codes]) if c != before + 1]
    ends = [c for c, after in zip(codes, [*codes[1:], 0]) if after != c + 1]
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends))


# Runs of letters: what is a word character but no number.
_WORD = re.compile(rf"[^\W\d_{_other_numbers()}]+")
_FLUSH = 200_000
_WORDS_AT_ONCE = 100_000


def packed(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Runs of four characters of all words as 64-bit numbers, and how many each word has."""
    flat = "".join(["   " + w + " " for w in words])
    codes = np.frombuffer(flat.encode("utf-32-le"), np.uint32).astype(np.uint64) & 0xFFFF
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 4
    runs = codes[:-3] << 48 | codes[1:-2] << 32 | codes[2:-1] << 16 | codes[3:]
    # A run that reaches into the next word ends in one of the three blanks before it.
    keep = np.ones(len(codes), bool)
    starts = np.cumsum(sizes) - sizes
    for k in range(3):
        keep[starts + k] = False
    return runs[keep[3:]].view(np.int64), sizes - 3


def low(runs: np.ndarray, n: int) -> np.ndarray:
    """The last ``n`` characters of packed runs."""
    return runs if n == 4 else runs & ((1 << 16 * n) - 1)


def context(runs: np.ndarray, n: int) -> np.ndarray:
    """The characters before the last of the last ``n`` characters of packed runs."""
    return (runs >> 16) & ((1 << 16 * (n - 1)) - 1)


def learned_text(docs: DataFrame, text: str, lang: str, doc_id: str) -> DataFrame:
    return docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")
    ).where(~rows.held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())


def run_counts(docs: DataFrame) -> DataFrame:
    """``lang``, packed run and count, one row each; tasks hand on partial counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, seen in words.items():
                if seen:
                    runs, sizes = packed(list(seen))
                    times = np.repeat(np.fromiter(seen.values(), np.int64, len(seen)), sizes)
                    unique, which = np.unique(runs, return_inverse=True)
                    n = np.bincount(which, times, len(unique)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(unique), pa.string()), pa.array(unique), pa.array(n)],
                        names=["lang", "run", "n"],
                    )
            words.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words[lang].update(_WORD.findall(text.lower()))
                if sum(map(len, words.values())) > _FLUSH:
                    yield from flush()
        yield from flush()

    partial = docs.select(F.col("lang").cast("string").alias("lang"), "text").mapInArrow(
        count, "lang string, run long, n long"
    )
    return partial.groupBy("lang", "run").agg(F.sum("n").alias("n"))


class Model:
    """For each order: sorted runs and contexts, and a column for each language.

    A run has its discounted count, a context its total and the weight of the lower order.
    """

    def __init__(self, languages: list[str], tables, alphabet: int, sharpness: float = 1.0, limit=None):
        self.languages, self.tables, self.alphabet = languages, tables, alphabet
        self.sharpness, self.limit = sharpness, limit

    def word_costs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cost in nats of every word in every language, and its characters."""
        runs, sizes = packed(words)
        unique, which = np.unique(runs, return_inverse=True)
        p = np.full((len(unique), len(self.languages)), 1.0 / self.alphabet)
        for n in range(1, ORDER + 1):
            seen, counts, contexts, totals, weights = self.tables[n]
            at, here = _places(seen, low(unique, n))
            over, known = _places(contexts, context(unique, n))
            share = np.where((here & known)[:, None], np.minimum(counts[at] / totals[over], 1.0), 0.0)
            p = share + np.where(known[:, None], weights[over], 1.0) * p
        cost = -np.log(np.minimum(p, 1.0))[which]
        return np.add.reduceat(cost, np.cumsum(sizes) - sizes, axis=0), sizes

    def cross_entropies(self, texts: list[str | None]) -> np.ndarray:
        """Nats per character of every text in every language; NaN without a letter."""
        out = np.full((len(texts), len(self.languages)), np.nan)
        found: list[list[str]] = []
        first = 0
        size = 0
        for i, text in enumerate(texts):
            found.append(_WORD.findall(text.lower()) if text else [])
            size += len(found[-1])
            if size > _WORDS_AT_ONCE or i == len(texts) - 1:
                out[first:i + 1] = self._of_words(found)
                found, first, size = [], i + 1, 0
        return out

    def _of_words(self, found: list[list[str]]) -> np.ndarray:
        numbers: dict[str, int] = {}
        ids = np.array([numbers.setdefault(w, len(numbers)) for ws in found for w in ws], np.int64)
        out = np.full((len(found), len(self.languages)), np.nan)
        if not len(ids):
            return out
        cost, chars = self.word_costs(list(numbers))
        counts = np.fromiter(map(len, found), np.int64, len(found))
        some = counts > 0
        starts = (np.cumsum(counts) - counts)[some]
        out[some] = np.add.reduceat(cost[ids], starts, axis=0) / np.add.reduceat(chars[ids], starts)[:, None]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        if not self.languages:
            n = len(texts)
            return [UNKNOWN] * n, np.zeros(n), np.full(n, np.nan), np.ones(n, bool)
        h = self.cross_entropies(texts)
        silent = np.isnan(h[:, 0])
        h = np.where(silent[:, None], 0.0, h)
        best = h.argmin(axis=1)
        least = h[np.arange(len(h)), best]
        share = 1 / np.exp(-self.sharpness * (h - least[:, None])).sum(axis=1)
        rejected = silent | (least > self.limit[best] if self.limit is not None else False)
        names = [UNKNOWN if s else self.languages[b] for b, s in zip(best, silent)]
        return names, np.where(silent, 0.0, share), np.where(silent, np.nan, least), rejected


class SpreadModel:
    """A model whose tables stay in Spark.

    For each order ``tables`` has a frame of ``run`` and ``counts`` and one of ``context``,
    ``totals`` and ``weights``, arrays with an element for each language.
    """

    def __init__(self, languages: list[str], tables, alphabet: int, sharpness: float = 1.0, limit=None):
        self.languages, self.tables, self.alphabet = languages, tables, alphabet
        self.sharpness, self.limit = sharpness, limit

    def run_costs(self, runs: DataFrame) -> DataFrame:
        """``run`` and its ``costs`` in nats in every language, of distinct runs."""
        found = runs.select("run", F.array_repeat(F.lit(1.0 / self.alphabet), len(self.languages)).alias("p"))
        for n in range(1, ORDER + 1):
            counts, contexts = self.tables[n]
            # One character has at most 65 536 values, however large the corpus.
            counts, contexts = F.broadcast(counts) if n == 1 else counts, F.broadcast(contexts) if n <= 2 else contexts
            found = found.withColumns({"low": _low(n), "context": _context(n)})
            found = found.join(counts.withColumnRenamed("run", "low"), "low", "left").join(contexts, "context", "left")
            share = F.when(F.col("counts").isNull(), F.lit(0.0)).otherwise(F.lit(1.0))
            new = F.transform("p", lambda p, i: F.least(
                share * F.coalesce(F.get("counts", i), F.lit(0.0)) / F.get("totals", i), F.lit(1.0)
            ) + F.get("weights", i) * p)
            found = found.select("run", F.when(F.col("totals").isNull(), F.col("p")).otherwise(new).alias("p"))
        return found.select("run", F.transform("p", lambda p: -F.log(F.least(p, F.lit(1.0)))).alias("costs"))

    def cross_entropies(self, texts: DataFrame, key: list[str], text: str) -> DataFrame:
        """``key`` and ``h``, nats per character in every language, of texts with a letter."""
        runs = rows.written(document_runs(texts, key, text), "text-runs")
        costs = rows.written(self.run_costs(runs.select("run").distinct()), "costs")
        each = [F.sum(F.col("n") * F.get("costs", F.lit(i))) / F.sum("n") for i in range(len(self.languages))]
        return runs.join(costs, "run").groupBy(*key).agg(F.array(*each).alias("h"))

    def prediction(self, h: Column) -> Column:
        """Language, score, cross-entropy and rejection from cross-entropies, null without a letter."""
        least = F.array_min(h)
        best = (F.array_position(h, least) - 1).cast("int")
        of_best = lambda values: F.get(F.array(*map(F.lit, values)), best)
        share = 1 / F.aggregate(h, F.lit(0.0), lambda total, x: total + F.exp(-self.sharpness * (x - least)))
        heard = h.isNotNull()
        return F.struct(
            F.when(heard, of_best(self.languages)).otherwise(UNKNOWN).alias("lang_pred"),
            F.when(heard, share).otherwise(0.0).alias("score"),
            least.alias("cross_entropy"),
            F.when(heard, least > of_best([float(x) for x in self.limit])).otherwise(True).alias("rejected"),
        )


def _low(n: int) -> Column:
    run = F.col("run")
    return run if n == 4 else run.bitwiseAND(F.lit((1 << 16 * n) - 1).cast("long"))


def _context(n: int) -> Column:
    return F.shiftrightunsigned("run", 16).bitwiseAND(F.lit((1 << 16 * (n - 1)) - 1).cast("long"))


def document_runs(texts: DataFrame, key: list[str], text: str) -> DataFrame:
    """``key``, ``run`` and ``n``: the distinct runs of every text and how often it has each."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place, value in enumerate(batch.column(len(key)).to_pylist()):
                words = _WORD.findall(value.lower())
                if words:
                    unique, n = np.unique(packed(words)[0], return_counts=True)
                    same = pa.array(np.full(len(unique), place))
                    yield pa.RecordBatch.from_arrays(
                        [*(batch.column(k).take(same) for k in range(len(key))), pa.array(unique), pa.array(n.astype(np.int64))],
                        names=[*key, "run", "n"],
                    )

    given = texts.where(F.col(f"`{text}`").isNotNull()).select(*key, F.col(f"`{text}`").alias("text"))
    kinds = ", ".join(f"`{c}` {given.schema[c].dataType.simpleString()}" for c in key)
    return given.mapInArrow(count, f"{kinds}, run long, n long")


def _places(seen: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted numbers, by binary search, and whether they are there."""
    at = np.minimum(np.searchsorted(seen, wanted), len(seen) - 1)
    return at, seen[at] == wanted


def _collected(df: DataFrame) -> dict[str, np.ndarray]:
    table = df.toArrow()
    return {name: table.column(name).to_numpy() for name in table.column_names}


def train(
    docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", collected: int = COLLECTED
) -> Model | SpreadModel:
    """A model of all documents that have a language and aren't held out.

    Counting is one pass over the texts; the counted runs are written to the shared folder.
    A model of more than ``collected`` runs times languages stays there.
    """
    learned = learned_text(docs, text, lang, doc_id)
    level = rows.written(run_counts(learned), "runs")
    languages = sorted(r["lang"] for r in level.select("lang").distinct().collect())
    if not languages:
        return Model([], {}, 1)
    small = level.select("run").distinct().count() * len(languages) <= collected
    tables = {}
    for n in range(ORDER, 0, -1):
        tables[n] = (_arrays if small else _frames)(level, languages, n)
        if n > 1:
            level = level.groupBy("lang", _low(n - 1).alias("run")).agg(F.count(F.lit(1)).alias("n"))
            level = level if small else rows.written(level, "runs")
    if small:
        return calibrated(Model(languages, tables, len(tables[1][0]) + 1), learned)
    return calibrated(SpreadModel(languages, tables, tables[1][0].count() + 1), learned)


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once + twice else 0.5


def _arrays(level: DataFrame, languages: list[str], n: int) -> tuple[np.ndarray, ...]:
    runs = _collected(level.select("lang", "run", "n"))
    contexts = _collected(
        level.groupBy("lang", _context(n).alias("context")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"))
    )
    seen, before = np.unique(runs["run"]), np.unique(contexts["context"])
    counts = np.zeros((len(seen), len(languages)))
    totals, weights = np.ones((len(before), len(languages))), np.ones((len(before), len(languages)))
    for i, name in enumerate(languages):
        own, over = runs["lang"] == name, contexts["lang"] == name
        times = runs["n"][own]
        discount = _discount(int((times == 1).sum()), int((times == 2).sum()))
        counts[np.searchsorted(seen, runs["run"][own]), i] = times - discount
        at = np.searchsorted(before, contexts["context"][over])
        totals[at, i] = contexts["n"][over]
        weights[at, i] = np.minimum(1.0, discount * contexts["kinds"][over] / contexts["n"][over])
    return seen, counts, before, totals, weights


def _frames(level: DataFrame, languages: list[str], n: int) -> tuple[DataFrame, DataFrame]:
    few = level.groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice"))
    discounts = {r["lang"]: _discount(r["once"], r["twice"]) for r in few.collect()}
    of = lambda name, value: F.sum(F.when(F.col("lang") == name, value))
    counts = level.groupBy("run").agg(
        F.array(*[F.coalesce(of(x, F.col("n") - discounts[x]), F.lit(0.0)) for x in languages]).alias("counts")
    )
    contexts = level.groupBy(_context(n).alias("context")).agg(
        F.array(*[F.coalesce(of(x, F.col("n")).cast("double"), F.lit(1.0)) for x in languages]).alias("totals"),
        F.array(
            *[F.coalesce(F.least(of(x, F.lit(discounts[x])) / of(x, F.col("n")), F.lit(1.0)), F.lit(1.0)) for x in languages]
        ).alias("weights"),
    )
    return rows.written(counts, "counts"), rows.written(contexts, "contexts")


def calibrated(model: Model | SpreadModel, learned: DataFrame) -> Model | SpreadModel:
    """The model with the sharpness of the best likelihood, and a limit for each language.

    The limit is four standard deviations above the mean cross-entropy that a language's
    own texts have under its own model.
    """
    sample = (
        learned.where(F.length("text") <= CALIBRATION_CHARS).orderBy(F.xxhash64("id"), "id", "text").limit(CALIBRATION)
        .select("text", F.col("lang").cast("string").alias("lang"))
    )
    if isinstance(model, SpreadModel):
        base, file, row = rows.keyed(rows.written(sample, "calibration"))
        found = model.cross_entropies(base, [file, row], "text")
        sample = base.join(found, [file, row]).select("lang", "h").collect()
        h = np.array([r["h"] for r in sample]).reshape(-1, len(model.languages))
    else:
        sample = sample.collect()
        h = model.cross_entropies([r["text"] for r in sample]) if sample else np.empty((0, len(model.languages)))
    truth = np.array([model.languages.index(r["lang"]) if r["lang"] in model.languages else -1 for r in sample], int)
    usable = ~np.isnan(h[:, 0]) & (truth >= 0)
    h, truth = h[usable], truth[usable]
    model.limit = np.full(len(model.languages), np.inf)
    if not len(h):
        return model
    own = h[np.arange(len(h)), truth]
    for i in range(len(model.languages)):
        mine = own[truth == i]
        if len(mine) > 1:
            model.limit[i] = mine.mean() + 4 * mine.std()
    likelihood = {}
    for sharpness in SHARPNESS:
        z = -sharpness * h
        z -= z.max(axis=1, keepdims=True)
        likelihood[sharpness] = (z[np.arange(len(h)), truth] - np.log(np.exp(z).sum(axis=1))).mean()
    model.sharpness = max(likelihood, key=likelihood.get)
    return model


def predictor(spark: SparkSession, model: Model):
    """Column function: language, score, cross-entropy and rejection of a text."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTION)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in rows.slices(batches):
            names, scores, costs, rejected = shared.value.predict(batch.to_pylist())
            yield pa.StructArray.from_arrays(
                [
                    pa.array(names, pa.string()), pa.array(scores), pa.array(costs, mask=np.isnan(costs)),
                    pa.array(rejected, pa.bool_()),
                ],
                names=["lang_pred", "score", "cross_entropy", "rejected"],
            )

    return predict


def predict_column(spark: SparkSession, model: Model, text: Column) -> Column:
    return predictor(spark, model)(text)


def predicted(docs: DataFrame, model: Model | SpreadModel, text: str = "text", name: str = "p") -> DataFrame:
    """``docs`` with language, score, cross-entropy and rejection in ``name``, by a model of any size.

    A column of ``docs`` that is called ``name`` gives way.
    """
    if isinstance(model, Model):
        return docs.withColumn(name, predict_column(docs.sparkSession, model, F.col(f"`{text}`")))
    base, file, row = rows.keyed(docs)
    found = base.join(model.cross_entropies(base, [file, row], text), [file, row], "left")
    return found.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != name.lower()], model.prediction(F.col("h")).alias(name))
