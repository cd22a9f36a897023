"""Soft-membership mixing of documents to target domain weights.

A classifier learned from a labelled table (logistic regression on
frequent words and character shares, fitted on a bounded hash sample of the
labelled rows) predicts how likely each document belongs to each domain.  A document
then counts for every domain with ``tokens * posterior``.  Nonnegative rates
(expected copies) are fitted by projected-gradient least squares, so that the
expected domain token totals match the targets.

Gradients are scaled per document by its tokens and, across domains, by the
inverse of the domains' Gram matrix, so one step solves the problem where no
rate is cut off at zero, and more steps are needed where some are; they gain
speed by momentum that starts anew where it points uphill.  Steps end when
every total is within ``tolerance``, or when a step moves no total by more
than ``still`` (targets that no rates, or only extreme ones, can meet);
``miss`` says how far the totals are off then.  A rate is a function of the
document's posteriors and of the step vectors; rates are stored every
``stored_steps`` steps only.  Each step is one distributed sum; what reaches the driver is one
number per domain and step (the Gram matrix once).  DataFrame functions and
``pyspark.ml`` only, no text goes through an exchange.

A token is a word here: a run of characters between spaces and punctuation.

Defined results: null is the empty text, with no token; a very long text is
one row like any other, its words one array; a label without a value (quality
and toxic both null) teaches nothing; a domain no labelled row has gets
posterior 0 and its target cannot be met; without labelled rows all rates are
1; an empty table gives an empty result; repeated rows have the same rate and
count once in the training sample; rates are rounded to 6 places.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import fresh_name, settle


@dataclass(frozen=True)
class MixConfig:
    targets: tuple = (("good", 0.92), ("poor", 0.04), ("toxic", 0.04))   # token shares
    total_tokens: int | None = None      # default: as many as the input has
    training_rows: int = 20_000
    vocabulary: int = 1024               # most frequent words of the training rows
    least_documents: int = 5             # that hold a word of the vocabulary
    regularisation: float = 0.01
    iterations: int = 30
    tolerance: float = 1e-7              # of the total, per domain
    still: float = 1e-6                  # of the total: a step that moves less is the last
    stored_steps: int = 32               # after so many steps rates are written

    @property
    def domains(self) -> list[str]:
        return [name for name, _ in self.targets]


def domain_of_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id, domain)`` from the quality and toxicity labels that have a value."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(
        F.coalesce("toxic", "quality").isNotNull(), "good")
    return labels.select("doc_id", domain.alias("domain")).filter("doc_id IS NOT NULL AND domain IS NOT NULL")


# What stands between words.
_BREAKS = r"""[ \t\n\x0b\x0c\r.,;:?()\[\]"']+"""


def _features(rows: DataFrame, text: Column) -> DataFrame:
    """``rows`` with ``__words``, their number ``__tokens``, and the shares
    of symbols, capitals and repeated words."""
    chars = F.greatest(F.length("__text"), F.lit(1)).cast("double")
    share = lambda pattern: 1 - F.length(F.regexp_replace("__text", pattern, "")) / chars
    df = rows.withColumn("__text", F.coalesce(text, F.lit("")))
    df = df.withColumn("__words", F.array_remove(F.split(F.lower("__text"), _BREAKS), ""))
    return df.withColumns({
        "__tokens": F.size("__words").cast("long"),
        "__symbols": share("[!#$%&*|<>]+"), "__upper": share(r"\p{Lu}+"),
        "__repeats": F.when(F.size("__words") > 0, 1 - F.size(F.array_distinct("__words")) / F.size("__words")).otherwise(0.0)})


_SHARES = ["__symbols", "__upper", "__repeats"]


def _vectors(features: DataFrame, words) -> DataFrame:
    df = VectorAssembler(inputCols=["__tf", *_SHARES], outputCol="__x").transform(words.transform(features))
    return df.drop("__words", "__tf", "__text", *_SHARES)


def fit_domains(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, config: MixConfig):
    """The fitted (vocabulary, classifier); an int if one domain is all there
    is, None if none."""
    number = F.create_map(*[F.lit(x) for k, d in enumerate(config.domains) for x in (d, float(k))])
    labelled = (labels.select(F.col("doc_id").alias("__id"), number[F.col("domain")].alias("__label"),
                              F.xxhash64(F.lit("mixing sample"), "doc_id", "domain").alias("__h"))
                .filter("__label IS NOT NULL"))
    # a threshold from the exact count, then exactly the smallest hashes
    near = F.pmod("__h", F.lit(1 << 40)) < int((1 << 40) * min(1.0, 2 * config.training_rows / max(1, labelled.count())))
    chosen = labelled.filter(near).orderBy("__h", "__id").limit(config.training_rows)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__raw"))
    # at most training_rows rows, so this broadcast is bounded; one id may have
    # any number of rows, so what it finds is sampled again, equal rows once
    found = settle(rows.select("__id", F.xxhash64(F.lit("mixing rows"), "__id", "__raw").alias("__g"))
                   .join(F.broadcast(chosen), "__id").groupBy("__id", "__g").count().select("__g"))
    part = F.pmod("__g", F.lit(1 << 40)) < int((1 << 40) * min(1.0, 2 * config.training_rows / max(1, found.count())))
    picked = found.filter(part).distinct().orderBy("__g").limit(config.training_rows)
    train = rows.withColumn("__g", F.xxhash64(F.lit("mixing rows"), "__id", "__raw")).join(
        F.broadcast(picked), "__g").join(F.broadcast(chosen), "__id").dropDuplicates(["__g", "__label"])
    train = settle(_features(train, F.col("__raw")).drop("__raw", "__text", "__g"))
    present = sorted(int(r[0]) for r in train.select("__label").distinct().collect())
    if len(present) < 2:
        return present[0] if present else None
    counter = CountVectorizer(inputCol="__words", outputCol="__tf", vocabSize=config.vocabulary, binary=True,
                              minDF=float(min(config.least_documents, train.count())))
    # a mark that no text has, so the vocabulary is never empty; it is constant, so it weighs nothing
    words = counter.fit(train.withColumn("__words", F.array_append("__words", F.lit(" "))))
    classifier = LogisticRegression(
        featuresCol="__x", labelCol="__label", probabilityCol="__prob", predictionCol="__pred",
        rawPredictionCol="__raw_score", family="multinomial", regParam=config.regularisation,
        maxIter=config.iterations)
    return words, classifier.fit(_vectors(train, words))


def with_posteriors(rows: DataFrame, text: Column, model, config: MixConfig) -> DataFrame:
    """``rows`` with ``__tokens`` and ``__p``, an array over the domains."""
    k = len(config.domains)
    if model is None or isinstance(model, int):
        fixed = F.array(*[F.lit(1.0 if i == model else 0.0) for i in range(k)])
        return _features(rows, text).select(*rows.columns, "__tokens", fixed.alias("__p"))
    words, classifier = model
    scored = classifier.transform(_vectors(_features(rows, text), words))
    known = vector_to_array("__prob")
    padded = F.concat(known, F.array_repeat(F.lit(0.0), k - classifier.numClasses))
    return scored.select(*rows.columns, "__tokens", padded.alias("__p"))


def _after(p: Column, state: Column, step: Column, k: int) -> Column:
    """The rate after one gradient step from ``state.y``, never below 0."""
    return F.greatest(F.lit(0.0), state["y"] - sum((F.element_at(p, i + 1) * F.element_at(step, i + 1) for i in range(k)), F.lit(0.0)))


def _state(p: Column, steps: list, start: Column | None = None) -> Column:
    """``(r, y)``, the rate and the point its next step starts from, after
    ``steps`` (a number per domain and the momentum) from ``start`` (1, 1).
    The steps are one literal: the expression is the same however many there are."""
    start = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("y")) if start is None else start
    if not steps:
        return start
    k = len(steps[0]) - 1

    def along(state, step):
        rate = _after(p, state, step, k)
        return F.struct(rate.alias("r"), (rate + F.element_at(step, k + 1) * (rate - state["r"])).alias("y"))

    return F.aggregate(_literal(steps), start, along)


def _literal(rows: list) -> Column:
    return F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in rows])


def _rate(p: Column, steps: list) -> Column:
    return _state(p, steps)["r"]


def fit_rates(masses: DataFrame, config: MixConfig) -> tuple[list, float]:
    """The step vectors of the rates over ``(__tokens, __p)``, and the miss:
    how far the total that is furthest off still is, as a share of all tokens
    wanted."""
    k = len(config.domains)
    p = [F.element_at("__p", i + 1) for i in range(k)]
    cells = [F.sum(F.col("__tokens") * p[i] * p[j]) for i in range(k) for j in range(k)]
    first = masses.agg(F.sum("__tokens").alias("t"), *[c.alias(f"g{n}") for n, c in enumerate(cells)],
                       *[F.sum(F.col("__tokens") * p[i]).alias(f"s{i}") for i in range(k)]).first()
    wanted = np.array([w for _, w in config.targets]) * float(config.total_tokens or first["t"] or 0)
    share = lambda miss: float(np.abs(miss).max() / max(wanted.sum(), 1.0))
    if not first["t"]:
        return [], share(wanted)
    gram = np.array([first[f"g{n}"] for n in range(k * k)]).reshape(k, k)
    if not gram.any():
        return [], share(wanted)
    inverse = np.linalg.pinv(gram, rcond=1e-10, hermitian=True)
    table = masses.select("__tokens", "__p", _state(F.col("__p"), []).alias("__s"))
    weight, state = F.col("__tokens"), F.col("__s")
    steps: list = []
    stored, momentum = 0, 1.0
    totals = at = np.array([first[f"s{i}"] for i in range(k)])      # of the rates; of the points y
    while True:
        move = inverse @ (at - wanted)
        # a domain without any mass cannot be moved
        if np.abs(gram @ (inverse @ (totals - wanted))).max() <= config.tolerance * wanted.sum():
            return steps, share(totals - wanted)
        if len(steps) - stored >= config.stored_steps:
            table = settle(table.withColumn("__s", _state(F.col("__p"), steps[stored:], state)))
            stored = len(steps)
        here = table.withColumn("__s", _state(F.col("__p"), steps[stored:], state))
        here = here.withColumn("__r", _after(F.col("__p"), state, _literal([move])[0], k))
        got = here.agg(*[F.sum(weight * F.col("__r") * p[i]).alias(f"s{i}") for i in range(k)],
                       F.sum(weight * (state["y"] - F.col("__r")) * (F.col("__r") - state["r"])).alias("uphill")).first()
        reached = np.array([got[f"s{i}"] for i in range(k)])
        later = 1.0 if got["uphill"] > 0 else (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
        push = 0.0 if got["uphill"] > 0 else (momentum - 1) / later
        steps.append([*move, push])
        if np.abs(reached - totals).max() <= config.still * wanted.sum():
            return steps, share(reached - wanted)
        at, totals, momentum = reached + push * (reached - totals), reached, later


def mixing_rates(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 config: MixConfig = MixConfig()) -> DataFrame:
    """``id_col``, ``n_tokens``, one posterior per domain, ``rate``, and the
    ``miss`` of the fit (see ``fit_rates``, rounded to 9 places)."""
    model = fit_domains(docs, labels, id_col, text_col, config)
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__raw"))
    masses = settle(with_posteriors(rows, F.col("__raw"), model, config).drop("__raw"))
    steps, miss = fit_rates(masses, config)
    return masses.select(
        F.col("__id").alias(id_col), F.col("__tokens").alias("n_tokens"),
        *[F.round(F.element_at("__p", i + 1), 6).alias(f"p_{d}") for i, d in enumerate(config.domains)],
        F.round(_rate(F.col("__p"), steps), 6).alias("rate"), F.lit(round(miss, 9)).alias("miss"))


def mix(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        config: MixConfig = MixConfig()) -> DataFrame:
    """The rows of ``docs``, each as often as its rate says: its whole part
    surely, the rest by a hash of id and text.  Rows are scored once and
    written with their posteriors; the steps read those only."""
    model = fit_domains(docs, labels, id_col, text_col, config)
    row, copy = fresh_name(docs, "row"), fresh_name(docs, "copy")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    scored = materialize(with_posteriors(packed, F.col(row)[text_col], model, config), "mixing")
    steps, _ = fit_rates(scored, config)
    rate = F.round(_rate(F.col("__p"), steps), 6)
    unit = F.pmod(F.xxhash64(F.lit("mixing copy"), F.col(row)[id_col], F.col(row)[text_col]), F.lit(1 << 40)) / float(1 << 40)
    times = (F.floor(rate) + F.when(unit < rate - F.floor(rate), 1).otherwise(0)).cast("int")
    return scored.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times))).select(f"{row}.*")


def op7_mixing(spark, sf_dir, config: MixConfig = MixConfig()):
    """Domain posteriors and rate of every row of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mixing_rates(docs, domain_of_labels(spark.read.parquet(f"{sf_dir}/labels.parquet")), config=config)
