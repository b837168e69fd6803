"""Quality filter: per-document perplexity under a Kneser-Ney model of trusted text.

The model is an interpolated modified Kneser-Ney model over bytes. Documents are
dealt into folds by their id, and each is scored by the model of the trusted
documents (labelled good and not toxic) of all other folds, so no document meets
a model that has seen it. The threshold of a language is a quantile of the
perplexity of all its trusted documents; a language without trusted documents
takes all its documents, and rows without a language all trusted documents.

Documents are dealt into groups of a few MB, each of one fold. A group sends its
distinct n-grams with their trusted counts; counts are summed, turned into
probabilities and looked up by joins on the n-gram, and each group gets back the
probabilities of the n-grams it has, to score its documents. Texts move to their
group twice, to be counted and to be scored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.shared import lean, text_groups, written
from tradeloom.llm.tokens import raw

ORDER = 4
SYMBOLS = 256
# Quantile of trusted documents above which a document is rejected.
QUANTILE = 0.995
FOLDS = 3
GROUP_BYTES = 16 << 20
_CHUNK = 1 << 20


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The doc_id of documents that every label row calls good and none toxic."""
    votes = labels.where("doc_id is not null").groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min(F.coalesce("quality", F.lit(0))).alias("good"),
        F.max(F.coalesce("toxic", F.lit(0))).alias("bad"))
    return votes.where("good = 1 and bad = 0").select("doc_id")


def _numbered(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each n-gram and the distinct ones, in order of their first place."""
    coded = pa.array(grams).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary.to_numpy()


class _Group:
    """Texts of a group, each after ORDER - 1 zero bytes."""

    def __init__(self, table: pa.Table):
        text = table.column("text")
        self.lengths = pc.fill_null(pc.binary_length(text), 0).to_numpy().astype(np.int64)
        self.ends = np.cumsum(self.lengths + ORDER - 1)
        # Byte i is at i + ORDER - 1, so that every byte has ORDER - 1 before it.
        self.bytes = np.zeros(ORDER - 1 + int(self.lengths.sum()) + (ORDER - 1) * len(text), dtype=np.uint8)
        at = 0
        for chunk in text.chunks:
            data, bounds = raw(chunk.cast(pa.large_string()).fill_null(""))
            for start, stop in zip(bounds.tolist(), bounds[1:].tolist()):
                at += ORDER - 1
                self.bytes[at + ORDER - 1 : at + ORDER - 1 + stop - start] = data[start:stop]
                at += stop - start

    def chunks(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """N-grams ending at the bytes of the texts, and the documents they are in."""
        begins = self.ends - self.lengths - (ORDER - 1)
        size = len(self.bytes) - (ORDER - 1)
        for start in range(0, size, _CHUNK):
            stop = min(start + _CHUNK, size)
            here = np.arange(*np.searchsorted(self.ends, [start, stop - 1], side="right") + [0, 1])
            first, last = (np.clip(x[here], start, stop) - start for x in (begins, self.ends))
            doc = np.repeat(here.astype(np.int32), last - first)
            inside = np.ones(stop - start, dtype=bool)
            for back in range(ORDER - 1):
                pads = begins[here] + back - start
                inside[pads[(pads >= 0) & (pads < stop - start)]] = False
            grams = np.zeros(stop - start, dtype=np.uint32)
            for back in range(ORDER - 1, -1, -1):
                grams <<= np.uint32(8)
                grams |= self.bytes[start + ORDER - 1 - back : stop + ORDER - 1 - back]
            yield grams[inside], doc[inside]


def _request(table: pa.Table, labels: pa.Table) -> pa.Table:
    """Distinct n-grams of a group with their counts in its trusted texts."""
    group = _Group(table)
    training = set(labels.column("doc_id").to_pylist())
    counted = np.array([d in training for d in table.column("doc_id").to_pylist()], dtype=bool)
    seen, counts = [], []
    for grams, doc in group.chunks():
        which, distinct = _numbered(grams)
        seen.append(distinct)
        counts.append(np.bincount(which[counted[doc]], minlength=len(distinct)))
    if not seen or not len(table):
        seen, counts = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
    which, distinct = _numbered(np.concatenate(seen))
    total = np.bincount(which, weights=np.concatenate(counts), minlength=len(distinct))
    g = table.column("g")[0].as_py() if len(table) else 0
    return pa.table({
        "g": pa.array(np.full(len(distinct), g, dtype=np.int32)),
        "gram": pa.array(distinct.astype(np.int64)),
        "n": pa.array(total.astype(np.int64)),
    })


def _score(table: pa.Table, known: pa.Table) -> pa.Table:
    group = _Group(table)
    grams, logs = known.column("gram").to_numpy(), known.column("log_p").to_numpy()
    order = np.argsort(grams)
    grams, logs = grams[order], logs[order]
    total = np.zeros(len(group.lengths))
    for found, doc in group.chunks():
        which, distinct = _numbered(found)
        total += np.bincount(
            doc, weights=logs[np.searchsorted(grams, distinct)][which], minlength=len(total))
    with np.errstate(invalid="ignore", divide="ignore"):
        perplexity = np.exp(-total / group.lengths)
    return pa.table({
        "doc_id": table.column("doc_id"), "text": table.column("text"), "carried": table.column("carried"),
        "n_bytes": pa.array(group.lengths),
        "perplexity": pa.array(perplexity, mask=group.lengths == 0),
    })


def _low(gram: Column, n: int) -> Column:
    """The last ``n`` symbols."""
    return gram.bitwiseAND(F.lit((1 << 8 * n) - 1))


def _discounts(level: DataFrame) -> dict[int, list[float]]:
    """Modified Kneser-Ney discounts of each fold for counts of 1, 2 and more."""
    by_fold = level.groupBy("fold").agg(*[F.count_if(F.col("c") == k).alias(f"n{k}") for k in range(1, 5)])
    found = {}
    for fold, *n in by_fold.collect():
        n1, n2, n3, n4 = (float(x) for x in n)
        if not (n1 and n2 and n3 and n4):  # too little text to estimate them
            found[fold] = [0.5, 0.75, 0.9]
            continue
        y = n1 / (n1 + 2 * n2)
        raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        found[fold] = [min(max(d, 0.1), k - 0.05) for k, d in enumerate(raw, 1)]
    return found


def _taken(discounts: dict[int, list[float]]) -> Column:
    """What is taken off a count of a fold."""
    out = F.lit(None).cast("double")
    for fold, (one, two, more) in discounts.items():
        by_count = F.when(F.col("c") == 1, one).when(F.col("c") == 2, two).otherwise(more)
        out = F.when(F.col("fold") == fold, by_count).otherwise(out)
    return out


def kneser_ney(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """From (fold, gram, c) of the highest order, a model for each fold: per order
    (fold, gram, p) of seen n-grams and (fold, context, backoff).

    Lower orders count the different symbols before an n-gram. Each order's
    probabilities are interpolated with those of the order below.
    """
    levels = {ORDER: counts}
    for n in range(ORDER - 1, 0, -1):
        levels[n] = written(levels[n + 1].groupBy("fold", _low(F.col("gram"), n).alias("gram")).agg(
            F.count("*").alias("c")))
    out: list[tuple[DataFrame, DataFrame]] = []
    for n in range(1, ORDER + 1):
        taken = _taken(_discounts(levels[n]))
        rows = levels[n].withColumn("context", F.shiftright("gram", 8))
        contexts = written(rows.groupBy("fold", "context").agg(
            F.sum("c").alias("total"), (F.sum(taken) / F.sum("c")).alias("backoff")))
        rows = rows.join(contexts, ["fold", "context"])
        if n == 1:
            lower = F.lit(1.0 / SYMBOLS)
        else:
            below = out[-1][0].select("fold", F.col("gram").alias("suffix"), F.col("p").alias("below"))
            rows = rows.withColumn("suffix", _low(F.col("gram"), n - 1)).join(below, ["fold", "suffix"])
            lower = F.col("below")
        p = (F.col("c") - taken) / F.col("total") + F.col("backoff") * lower
        out.append((written(rows.select("fold", "gram", p.alias("p"))), contexts.select("fold", "context", "backoff")))
    return out


def log_probabilities(grams: DataFrame, model: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(fold, gram, log_p) of distinct n-grams under the model of their fold;
    unseen ones back off to shorter contexts."""
    rows = grams
    for n, (seen, contexts) in enumerate(model, 1):
        seen = seen.select("fold", F.col("gram").alias(f"s{n}"), F.col("p").alias(f"p{n}"))
        contexts = contexts.select("fold", F.col("context").alias(f"s{n}"), F.col("backoff").alias(f"b{n}"))
        # Tables of at most 65,536 rows a fold by their key are broadcast.
        seen = F.broadcast(seen) if n <= 2 else seen
        contexts = F.broadcast(contexts) if n <= 3 else contexts
        low, keys = _low(F.col("gram"), n), ["fold", f"s{n}"]
        rows = rows.withColumn(f"s{n}", low).join(seen, keys, "left")
        rows = rows.withColumn(f"s{n}", F.shiftright(low, 8)).join(contexts, keys, "left").drop(f"s{n}")
    p = F.lit(1.0 / SYMBOLS)
    for n in range(1, ORDER + 1):
        p = F.coalesce(F.col(f"p{n}"), F.coalesce(F.col(f"b{n}"), F.lit(1.0)) * p)
    return rows.select("fold", "gram", F.log(p).alias("log_p"))


def perplexities(
    docs: DataFrame, labels: DataFrame, carry: list[str] | tuple[str, ...] = (),
    group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """(doc_id, text, carried, n_bytes, perplexity) per document; perplexity per
    byte under the model of the other folds, NULL for empty and NULL texts.
    ``carried`` has the columns of ``carry``; the text is always returned."""
    groups = -(-text_groups(docs, group_bytes) // FOLDS) * FOLDS  # a group is of fold g % FOLDS
    deal = lambda *c: F.pmod(F.xxhash64(*c), F.lit(groups)).cast("int").alias("g")
    carried = F.struct(*[docs[c] for c in carry]) if carry else F.lit(None).cast("int")
    unnamed = F.when(F.col("doc_id").isNull(), F.col("text"))
    dealt = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", carried.alias("carried"),
        deal(F.col("doc_id").cast("long"), unnamed),
    )
    fold = F.pmod("g", F.lit(FOLDS)).alias("fold")
    ids = trusted_ids(labels).select("doc_id", deal(F.col("doc_id")))
    requests = written(dealt.select("doc_id", "text", "g").groupBy("g").cogroup(ids.groupBy("g")).applyInArrow(
        lean(_request), "g int, gram long, n long"))
    grams = written(requests.groupBy(fold, "gram").agg(F.sum("n").alias("c")))
    others = F.array_remove(F.array(*[F.lit(k) for k in range(FOLDS)]), F.col("fold"))
    counts = grams.where("c > 0").select(F.explode(others).alias("fold"), "gram", "c")
    model = kneser_ney(written(counts.groupBy("fold", "gram").agg(F.sum("c").alias("c"))))
    known = requests.select("g", fold, "gram").join(
        log_probabilities(grams.select("fold", "gram"), model), ["fold", "gram"]).select("g", "gram", "log_p")
    kept = dealt.schema["carried"].dataType.simpleString()
    return dealt.groupBy("g").cogroup(known.groupBy("g")).applyInArrow(
        lean(_score), f"doc_id long, text string, carried {kept}, n_bytes long, perplexity double")


def judged(
    docs: DataFrame, labels: DataFrame, carry: list[str] | tuple[str, ...] = (),
    quantile: float = QUANTILE,
) -> DataFrame:
    """(doc_id, lang, n_bytes, perplexity, threshold, keep, text, carried) per document.

    A document is kept if its perplexity is at most its language's threshold,
    the quantile over that language's trusted documents at any number of them. A
    language without trusted documents takes the quantile over all its
    documents; rows without a language, which are all where the table has no
    column ``lang``, take it over all trusted documents.
    Documents without text are rejected. Without any trusted text nothing is
    known and every document with text is kept. Rows without doc_id are scored
    but never trained on; repeated rows come back repeated. ``carried`` has the
    columns of ``carry`` but the text.
    """
    lang = next((c for c in docs.columns if c.lower() == "lang"), None)
    if lang is None:
        lang, docs = "lang", docs.withColumn("lang", F.lit(None).cast("string"))
    columns = list(dict.fromkeys([*[c for c in carry if c != "text"], lang]))
    found = perplexities(docs, labels, columns)
    scored = written(found if "text" in carry else found.drop("text")).withColumn("lang", F.col("carried")[lang])
    trusted = written(scored.join(trusted_ids(labels), "doc_id").where("perplexity is not null").select(
        "lang", "perplexity"))
    limit = F.percentile_approx("perplexity", F.lit(quantile), F.lit(100_000))
    pooled = trusted.agg(limit.alias("pooled")).first()[0]
    judged_by = trusted
    if pooled is not None:
        judged_by = trusted.unionByName(scored.where("perplexity is not null").select("lang", "perplexity").join(
            trusted.select("lang").distinct(), "lang", "left_anti"))
    by_lang = written(judged_by.where("lang is not null").groupBy(F.col("lang").alias("_lang")).agg(
        limit.alias("_limit")))
    threshold = F.coalesce(F.col("_limit"), F.lit(pooled).cast("double"))
    keep = F.col("perplexity").isNotNull() & F.coalesce(
        F.col("perplexity") <= F.col("threshold"), F.lit(True))
    return scored.join(by_lang, F.col("lang") == F.col("_lang"), "left").withColumn(
        "threshold", threshold).withColumn("keep", keep).select(
        "doc_id", "lang", "n_bytes", "perplexity", "threshold", "keep",
        *(["text"] if "text" in carry else []), "carried")


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``judged`` without texts; rows and special cases as there."""
    return judged(docs, labels).drop("carried")


def kept_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the filter keeps, with all their columns. Documents
    without text go; repeated rows and rows without doc_id are judged like any
    other and stay repeated; an empty table stays empty."""
    kept = judged(docs, labels, carry=docs.columns).where("keep")
    return kept.select(*[F.col("text") if c == "text" else F.col("carried")[c].alias(c) for c in docs.columns])
