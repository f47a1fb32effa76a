"""Quality by perplexity under an interpolated modified Kneser-Ney model of character n-grams.

The model of a language is trained on its trusted text: all documents labelled good and not toxic, but for the
half of them (by a hash of the id) that with all toxic ones sets the threshold. Counts, continuation counts,
discounts and back-off weights are joins and aggregations of (language, n-gram) rows.

Scoring runs over all documents. Each task of the scan asks for the distinct n-grams of its documents
(a *block*); the requests meet the counts in joins sharded by n-gram; the answers come back by block
and meet the block's texts, which travel compressed, and give every document's perplexity. A
document is rejected if its perplexity lies above its language's threshold, a quantile over trusted
documents that the model was not trained on, chosen by what it lets through of toxic ones.

An n-gram is one number of 16 bits per UTF-16 unit, so that every character counts as itself, those
beyond 65,535 as their two units (digits as 0, white space other than line ends as a blank).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from payscope.llm.common import released, slices, stored, tasks

ORDER, BITS = 4, 16
SLICE_BYTES = 1 << 20
# A language's threshold is one of these quantiles of its held-out trusted documents: by the share of its
# held-out toxic documents that it rejects, less that of the trusted ones, the highest within one standard
# error of the best; without toxic documents, QUANTILE.
QUANTILES, QUANTILE = (0.95, 0.96, 0.97, 0.98, 0.99), 0.97
# A document's log perplexity counts as if so many characters at its language's median went along, so
# that a few words do not condemn a short one.
PRIOR_CHARS = 100

BLOCK, LOG_P, CHARS = "__block", "__log_perplexity", "__n_chars"

_FOLD = np.arange(1 << BITS, dtype=np.int64)
_FOLD[[*range(0x30, 0x3A)]] = 0x30
_FOLD[[0x09, 0x0B, 0x0C, 0x0D, 0xA0]] = 0x20


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram ending at each UTF-16 unit, index of each text's first and at the end their number)."""
    pad = "\0" * (ORDER - 1)
    units = [t.encode("utf-16-le", "surrogatepass") for t in texts]
    blank = pad.encode("utf-16-le")
    symbols = _FOLD[np.frombuffer(blank + blank.join(units), "<u2")]
    codes = np.zeros(len(symbols), np.int64)
    for k in range(ORDER):
        codes[k:] |= symbols[: len(symbols) - k] << (BITS * k)
    sizes = np.array([len(u) // 2 for u in units], np.int64)
    begins = np.cumsum(sizes + len(pad)) - sizes
    keep = np.ones(len(symbols), bool)
    for k in range(1, ORDER):
        keep[begins - k] = False
    return codes[keep], np.append(0, np.cumsum(sizes))


def _by_lang(part: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, list[str]]]:
    """(language, its rows, their texts); the first columns are text and language, null is ''."""
    texts, langs = ([x or "" for x in part.column(k).to_pylist()] for k in (0, 1))
    langs = np.array(langs, object)
    for lang in dict.fromkeys(langs):
        at = np.flatnonzero(langs == lang)
        yield lang, at, [texts[i] for i in at]


@released
def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, lang, gram, n): distinct n-grams of the task and how often each occurs."""
    found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    fresh: dict[str, list[np.ndarray]] = {}

    def merge(lang: str) -> None:
        have, n = found.get(lang, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        codes, counts = np.unique(np.concatenate(fresh.pop(lang)), return_counts=True)
        both, where = np.unique(np.concatenate([have, codes]), return_inverse=True)
        total = np.bincount(where, np.concatenate([n, counts]), len(both)).astype(np.int64)
        found[lang] = both, total

    block = 0
    for part in slices(batches, 0, SLICE_BYTES):
        block = part.column(BLOCK)[0].as_py()
        for lang, _, texts in _by_lang(part):
            fresh.setdefault(lang, []).append(grams(texts)[0])
            if sum(map(len, fresh[lang])) > 1 << 20:
                merge(lang)
    for lang in list(fresh):
        merge(lang)
    for lang, (codes, n) in found.items():
        yield pa.RecordBatch.from_pydict(
            {
                BLOCK: pa.array(np.full(len(codes), block, np.int32)),
                "lang": pa.array([lang] * len(codes), pa.string()),
                "gram": codes,
                "n": n,
            }
        )


@released
def _sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a block as compressed Arrow batches, a slice to a row."""
    pack = zstandard.ZstdCompressor(level=3).compress
    for part in slices(batches, 0, SLICE_BYTES):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema) as out:
            out.write_batch(part)
        yield pa.RecordBatch.from_pydict(
            {BLOCK: part.column(BLOCK).slice(0, 1), "docs": pa.array([pack(sink.getvalue())], pa.binary())}
        )


@released
def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by block, its answers before its documents."""
    unpack = zstandard.ZstdDecompressor().decompress
    block, answers = None, {}
    for batch in batches:
        for begin, number, is_docs in _stretches(batch):
            part = batch.slice(begin, number)
            if part.column(BLOCK)[0].as_py() != block:
                block, answers = part.column(BLOCK)[0].as_py(), {}
            if not is_docs:
                langs = part.column("lang").dictionary_encode()
                codes = langs.indices.to_numpy()
                for k, lang in enumerate(langs.dictionary.to_pylist()):
                    at = codes == k
                    answers.setdefault(lang, []).append(
                        (part.column("gram").to_numpy()[at], part.column("log_p").to_numpy()[at])
                    )
                continue
            for lang, parts in answers.items():
                if len(parts) > 1 or not isinstance(parts, tuple):
                    gram, log_p = (np.concatenate(x) for x in zip(*parts))
                    order = np.argsort(gram)
                    answers[lang] = ((gram[order], log_p[order]),)
            for packed in part.column("docs").to_pylist():
                for docs in pa.ipc.open_stream(unpack(packed)):
                    yield _scores(docs, answers)


def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bool]]:
    blocks = batch.column(BLOCK).to_numpy()
    is_docs = batch.column("docs").is_valid().to_numpy(zero_copy_only=False)
    cuts = np.flatnonzero((blocks[1:] != blocks[:-1]) | (is_docs[1:] != is_docs[:-1])) + 1
    for a, b in zip([0, *cuts], [*cuts, len(blocks)]):
        if b > a:
            yield int(a), int(b - a), bool(is_docs[a])


def _scores(docs: pa.RecordBatch, answers: dict) -> pa.RecordBatch:
    mean = np.full(docs.num_rows, np.nan)
    for lang, at, texts in _by_lang(docs):
        if lang not in answers:
            continue
        gram, log_p = answers[lang][0]
        codes, begins = grams(texts)
        place = np.minimum(np.searchsorted(gram, codes), len(gram) - 1)
        if (gram[place] != codes).any():
            raise ValueError("the documents changed between two reads; store them first")
        sums = np.append(0.0, np.cumsum(log_p[place], dtype=np.float64))
        n = np.array([len(t) for t in texts], np.int64)
        mean[at[n > 0]] = -((sums[begins[1:]] - sums[begins[:-1]])[n > 0] / n[n > 0])
    sizes = pa.array([len(t or "") for t in docs.column(0).to_pylist()], pa.int64())
    return pa.RecordBatch.from_arrays(
        [*docs.columns[:-1], pa.array(mean, from_pandas=True), sizes],
        names=[*docs.schema.names[:-1], LOG_P, CHARS],
    )


def _mask(order: int) -> Column:
    """The last ``order`` units; of all four, every bit of a long."""
    return F.lit((1 << (BITS * order)) - 1 if order < ORDER else -1).cast("long")


def train(counts: DataFrame) -> list[DataFrame]:
    """Model tables of orders 1 up, from (lang, gram, n) of the highest order: lang, gram, p, gamma.

    ``p`` is the interpolated probability of the last character after the others; ``gamma`` the
    weight that the n-gram, as a context, gives to the next lower order.
    """
    grams_of = {ORDER: counts.select("lang", "gram", F.col("n").cast("double").alias("c"))}
    for order in range(ORDER - 1, 0, -1):
        grams_of[order] = grams_of[order + 1].groupBy(
            "lang", F.col("gram").bitwiseAND(_mask(order)).alias("gram")
        ).agg(F.count(F.lit(1)).cast("double").alias("c"))
    alphabet = grams_of[1].groupBy("lang").agg((F.count(F.lit(1)) + 1).alias("alphabet"))
    tables: list[DataFrame] = []
    contexts: dict[int, DataFrame] = {}
    for order in range(1, ORDER + 1):
        rows = grams_of[order]
        n1, n2, n3, n4 = (F.count(F.when(F.col("c") == k, 1)).cast("double") for k in (1, 2, 3, 4))
        y = n1 / F.greatest(n1 + 2 * n2, F.lit(1.0))

        def discount(k: int, a: Column, b: Column) -> Column:
            found = k - (k + 1) * y * b / F.greatest(a, F.lit(1.0))
            return F.when((a > 0) & (found > 0), F.least(found, F.lit(float(k)))).otherwise(0.5 * k)

        # One row per language.
        cut = rows.groupBy("lang").agg(
            discount(1, n1, n2).alias("d1"), discount(2, n2, n3).alias("d2"), discount(3, n3, n4).alias("d3")
        )
        context = F.shiftrightunsigned("gram", BITS)
        taken = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        rows = rows.join(cut, "lang").select("lang", "gram", "c", context.alias("context"), taken.alias("d"))
        weights = rows.groupBy("lang", "context").agg(
            F.sum("c").alias("total"), (F.sum("d") / F.sum("c")).alias("gamma")
        )
        contexts[order] = weights
        rows = rows.join(weights, ["lang", "context"])
        if order == 1:
            lower = rows.join(alphabet, "lang").withColumn("q", 1 / F.col("alphabet"))
        else:
            below = tables[-1].select("lang", F.col("gram").alias("suffix"), F.col("p").alias("q"))
            lower = rows.withColumn("suffix", F.col("gram").bitwiseAND(_mask(order - 1))).join(
                below, ["lang", "suffix"]
            )
        p = (F.col("c") - F.col("d")) / F.col("total") + F.col("gamma") * F.col("q")
        tables.append(stored(lower.select("lang", "gram", p.alias("p")), f"model-{order}"))
    # A context of the order above; order 0 is the empty context.
    empty = contexts[1].join(alphabet, "lang").select(
        "lang", F.lit(0).cast("long").alias("gram"), (F.col("gamma") / F.col("alphabet")).alias("p")
    )
    model = [stored(empty, "model-0")]
    for order in range(1, ORDER + 1):
        if order == ORDER:
            model.append(tables[order - 1].withColumn("gamma", F.lit(None).cast("double")))
        else:
            above = contexts[order + 1].select("lang", F.col("context").alias("gram"), "gamma")
            model.append(stored(tables[order - 1].join(above, ["lang", "gram"], "left"), f"weights-{order}"))
    return model


def answer(needed: DataFrame, model: list[DataFrame]) -> DataFrame:
    """lang, gram, log_p for every n-gram asked for in a language that has a model.

    Unseen n-grams back off: p of the shorter one times the weight of the context, if that is known.
    """
    empty = model[0].select("lang", F.col("p").alias("p0"))
    rows = needed.join(empty, "lang")
    for order in range(1, ORDER + 1):
        own = model[order].select("lang", F.col("gram").alias(f"g{order}"), F.col("p").alias(f"p{order}"))
        rows = rows.withColumn(f"g{order}", F.col("gram").bitwiseAND(_mask(order))).join(
            own, ["lang", f"g{order}"], "left"
        )
        if order > 1:
            context = model[order - 1].select(
                "lang", F.col("gram").alias(f"h{order}"), F.col("gamma").alias(f"w{order}")
            )
            rows = rows.withColumn(f"h{order}", F.shiftrightunsigned(f"g{order}", BITS)).join(
                context, ["lang", f"h{order}"], "left"
            )
    p = reduce(
        lambda lower, k: F.coalesce(
            f"p{k}", lower * (F.coalesce(f"w{k}", F.lit(1.0)) if k > 1 else F.lit(1.0))
        ),
        range(1, ORDER + 1),
        F.col("p0"),
    )
    return rows.select("lang", "gram", F.log(p).cast("float").alias("log_p"))


def _judged(labels: DataFrame) -> DataFrame:
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.coalesce("quality", F.lit(0))).alias("q"), F.max(F.coalesce("toxic", F.lit(0))).alias("t")
    )


def label_bits(labels: DataFrame) -> DataFrame:
    """One row for 64 neighbouring ids, __word, with a bit for each trusted one (all its labels are good and
    not toxic) and for each toxic one (a label says so); words without either are left out."""
    one = F.call_function("shiftleft", F.lit(1).cast("long"), _place("doc_id"))
    kinds = {"__trusted_bits": "q = 1 AND t = 0", "__toxic_bits": "t = 1"}
    bits = [F.coalesce(F.bit_or(F.when(F.expr(rule), one)), F.lit(0).cast("long")).alias(c) for c, rule in kinds.items()]
    rows = _judged(labels).where(" OR ".join(f"({rule})" for rule in kinds.values()))
    return stored(rows.groupBy(_word("doc_id").alias("__word")).agg(*bits), "label-bits")


def _word(id_col: str) -> Column:
    return F.shiftright(F.col(f"`{id_col}`").cast("long"), 6)


def _place(id_col: str) -> Column:
    return F.col(f"`{id_col}`").cast("long").bitwiseAND(F.lit(63).cast("long")).cast("int")


def _has(bits: str, id_col: str) -> Column:
    bit = F.call_function("shiftrightunsigned", F.col(bits), _place(id_col)).bitwiseAND(F.lit(1).cast("long")) == 1
    return F.coalesce(bit, F.lit(False))


def requested(docs: DataFrame) -> DataFrame:
    """Rows (block, lang, gram): the distinct n-grams of each block of ``docs`` (text and language first)."""
    docs = docs.withColumn(BLOCK, F.spark_partition_id())
    return stored(docs.mapInArrow(_tally, f"{BLOCK} int, lang string, gram long, n long").drop("n"), "requests")


def score(docs: DataFrame, requests: DataFrame, answers: DataFrame) -> DataFrame:
    """``docs`` (text and language first) with log perplexity per character and size.

    ``requests`` are those of ``docs``, ``answers`` those of the model to them and maybe to more. The documents are
    read again in the partitions of the requests, so ``docs`` must be a stored table.
    """
    # The task of the scan, whatever is put around it.
    docs = docs.withColumn(BLOCK, F.spark_partition_id())
    sent = docs.mapInArrow(_sent, f"{BLOCK} int, docs binary")
    none = {"lang": "string", "gram": "long", "log_p": "float"}
    both = requests.join(answers, ["lang", "gram"]).select(
        BLOCK, "lang", "gram", "log_p", F.lit(None).cast("binary").alias("docs")
    ).unionByName(sent.withColumns({c: F.lit(None).cast(t) for c, t in none.items()}))
    schema = T.StructType([*docs.schema.fields[:-1]]).add(LOG_P, "double").add(CHARS, "long")
    return (
        both.repartition(tasks(docs.sparkSession), BLOCK)
        .sortWithinPartitions(BLOCK, F.col("docs").isNotNull())
        .mapInArrow(_scored, schema)
    )


def _shrunk(middle: str, prior_chars: int) -> Column:
    n = F.col(CHARS)
    return (n * F.col(LOG_P) + prior_chars * F.col(middle)) / (n + prior_chars)


def thresholds(unseen: DataFrame, quantiles: tuple[float, ...], quantile: float, prior_chars: int) -> DataFrame:
    """__lang, __middle, __threshold from scored documents with __lang and __toxic, which no model has seen."""
    unseen = stored(unseen.where(F.col(LOG_P).isNotNull()).select("__lang", "__toxic", LOG_P, CHARS), "unseen-scores")
    clean = F.col("__toxic") == F.lit(False)
    middles = unseen.where(clean).groupBy("__lang").agg(F.percentile_approx(LOG_P, 0.5, 10_000).alias("__middle"))
    rows = unseen.join(F.broadcast(middles), "__lang").withColumn("s", _shrunk("__middle", prior_chars))
    every = [quantile, *quantiles]
    cuts = rows.where(clean).groupBy("__lang", "__middle").agg(F.percentile_approx("s", every, 10_000).alias("cuts"))
    shares = [
        F.avg(F.when(F.col("__toxic") == F.lit(toxic), (F.col("s") > F.col("cuts")[k]).cast("int")))
        for toxic in (True, False) for k in range(1, len(every))
    ]
    judged = rows.drop("__middle").join(F.broadcast(cuts), "__lang").groupBy("__lang", "__middle", "cuts").agg(
        F.count(F.when(F.col("__toxic"), 1)).alias("n_toxic"),
        F.array(*shares[: len(quantiles)]).alias("caught"), F.array(*shares[len(quantiles):]).alias("lost"),
    )
    found = []
    for r in judged.collect():  # one row per language of the trusted text
        best = 0
        if r.caught[0] is not None:
            gain = [c - n for c, n in zip(r.caught, r.lost)]
            c = r.caught[gain.index(max(gain))]
            enough = max(gain) - (c * (1 - c) / r.n_toxic) ** 0.5
            best = max((k for k in range(len(quantiles)) if gain[k] >= enough), key=lambda k: quantiles[k]) + 1
        found.append((r["__lang"], r["__middle"], r.cuts[best]))
    return unseen.sparkSession.createDataFrame(found, "__lang string, __middle double, __threshold double")


def classify(
    docs: DataFrame, labels: DataFrame, quantiles: tuple[float, ...] = QUANTILES,
    quantile: float = QUANTILE, prior_chars: int = PRIOR_CHARS, id_col: str = "doc_id",
    text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """Every row and column of ``docs`` with __log_perplexity (per character), __threshold, __trusted
    and __rejected.

    Documents of a language without trusted text and empty or null texts have no perplexity and are
    kept; a null language is the language ''. Repeated rows are scored alike. Labels of unknown ids
    are without effect. ``docs`` must be a stored table, see ``score``.
    """
    first = [text_col, lang_col]
    docs = docs.select(*[f"`{c}`" for c in (*first, *(c for c in docs.columns if c not in first))])
    # A row for 64 ids: Spark broadcasts these while they are few, and else shuffles the rows by them.
    marks = label_bits(labels)
    known = docs.where(F.col(f"`{id_col}`").isNotNull()).join(marks, _word(id_col) == F.col("__word"))
    held = stored(
        known.where(_has("__trusted_bits", id_col) | _has("__toxic_bits", id_col)).select(
            f"`{text_col}`", f"`{lang_col}`", _has("__toxic_bits", id_col).alias("__toxic"),
            (_has("__trusted_bits", id_col) & (F.xxhash64(f"`{id_col}`") % 2 == 0)).alias("__trains"),
        ),
        "trusted-text",
    )
    # One half of the trusted trains; the other and the toxic, which the model has not seen, set the thresholds.
    counts = held.where("__trains").drop("__trains", "__toxic").withColumn(BLOCK, F.lit(0)).mapInArrow(_tally, f"{BLOCK} int, lang string, gram long, n long")
    model = train(stored(counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "gram-counts"))
    unseen = held.where("NOT __trains").drop("__trains")
    lang = F.coalesce(f"`{lang_col}`", F.lit(""))
    # The n-grams of the documents that set the thresholds are among those of all, so the model is asked once.
    requests = requested(docs)
    answers = stored(answer(requests.select("lang", "gram").distinct(), model), "answers")
    scored = score(unseen, requested(unseen), answers)
    limits = thresholds(scored.withColumn("__lang", lang), quantiles, quantile, prior_chars)
    # Rows without an id meet no label; their keys are spread out.
    key = F.coalesce(_word(id_col), F.xxhash64(LOG_P, CHARS))
    return (
        score(docs, requests, answers)
        .join(F.broadcast(limits), lang == F.col("__lang"), "left")
        .join(marks.drop("__toxic_bits"), key == F.col("__word"), "left")
        .withColumns({
            "__trusted": _has("__trusted_bits", id_col),
            "__rejected": F.coalesce(_shrunk("__middle", prior_chars) > F.col("__threshold"), F.lit(False)),
        })
        .drop("__lang", "__middle", "__word", "__trusted_bits", CHARS)
    )
