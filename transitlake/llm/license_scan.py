"""Licence scans by a trained paragraph classifier, on DataFrame functions alone.

A paragraph is a line with the lines it was wrapped into: a line break joins two lines
when the first is long and ends no sentence. Its features are the words and word pairs
that occur in the training texts (``licences``). A multinomial logistic regression over
them gives probabilities for the families, for licences of no family and for ``none``;
they are calibrated by a temperature fitted on left-out texts. A named family is
confirmed by comparison with the texts of that family.

Training reads the bounded texts of ``licences`` and nothing of the corpus; the model is
a table of some thousand features, whose names become literals of the plan.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from transitlake.llm.common import stored, whole_text
from transitlake.llm.licences import FORMS, NAMES, NONE, NOTICES, STOP, UNKNOWN

STEPS, RATE, DECAY, FOLDS = 300, 0.3, 6e-3, 3
# A line of at least this many characters that ends no sentence goes on in the next one.
WRAPPED = 40
# Training rows without any feature, for the weight of ``none`` where little is said.
BLANKS = 60
WORD = r"[\p{L}\p{N}]+(?:[.+][\p{L}\p{N}]+)*"


def words(text: str) -> list[str]:
    """The words of a notice, as the plan below takes them from a line."""
    out, word = [], ""
    low = text.lower() + " "
    for i, c in enumerate(low):
        if c.isalpha() or c.isnumeric() or (c in ".+" and word and low[i + 1 : i + 2].isalnum()):
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def features(text: str) -> frozenset[str]:
    """Words and word pairs, without those of stop words alone."""
    w = words(text)
    pairs = zip(w, w[1:], strict=False)
    return frozenset(x for x in w if x not in STOP) | frozenset(
        f"{a} {b}" for a, b in pairs if not (a in STOP and b in STOP)
    )


Weights = dict[str, list[float]]


def _probabilities(weights: Weights, bias: list[float], feats, heat: float = 1.0) -> list[float]:
    """Class probabilities; the weights of a text's features count by their root number."""
    known = [weights[f] for f in feats if f in weights]
    scale = math.sqrt(max(len(known), 1))
    z = [b + sum(w[k] for w in known) / scale for k, b in enumerate(bias)]
    top = max(z)
    e = [math.exp((x - top) / heat) for x in z]
    return [x / sum(e) for x in e]


def _fit(rows: list[tuple[frozenset[str], int]], classes: int) -> tuple[Weights, list[float]]:
    """Gradient descent on the log loss with weight decay; deterministic."""
    names = sorted({f for feats, _ in rows for f in feats})
    place = {f: i for i, f in enumerate(names)}
    x = np.zeros((len(rows), len(names)))
    for i, (feats, _) in enumerate(rows):
        for f in feats:
            x[i, place[f]] = 1 / math.sqrt(len(feats))
    goal = np.eye(classes)[[y for _, y in rows]]
    w, bias = np.zeros((len(names), classes)), np.zeros(classes)
    for _ in range(STEPS):
        z = x @ w + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        off = p / p.sum(axis=1, keepdims=True) - goal
        bias -= RATE * off.mean(axis=0)
        w -= RATE * (x.T @ off + DECAY * w)
    return dict(zip(names, w.tolist(), strict=True)), bias.tolist()


@lru_cache
def trained() -> tuple[list[str], Weights, list[float], float]:
    """Families (``none`` first), weights, biases and the temperature."""
    families = sorted(NOTICES, key=lambda f: (f != NONE, f))
    rows = [(features(t), families.index(f)) for f in families for t in NOTICES[f]]
    rows += [
        (features(form.format(name)), families.index(f))
        for f, names in NAMES.items()
        for name in names
        for form in FORMS
    ]
    # most lines have no feature at all
    rows += [(frozenset(), 0)] * BLANKS
    # what several families share licenses nothing alone, nor two of its words by chance
    shared = sorted(
        f
        for f in {f for feats, _ in rows for f in feats}
        if len({y for feats, y in rows if f in feats}) > 1
    )
    single = [f for f in shared if " " not in f]
    rows += [(frozenset([f]), 0) for f in single]
    rows += [(frozenset([f, single[i * 7 % len(single)]]), 0) for i, f in enumerate(single)]
    held = []
    for part in range(FOLDS):
        weights, bias = _fit([r for i, r in enumerate(rows) if i % FOLDS != part], len(families))
        held += [(weights, bias, r) for i, r in enumerate(rows) if i % FOLDS == part]

    def loss(heat: float) -> float:
        return -sum(math.log(_probabilities(w, b, f, heat)[y] + 1e-12) for w, b, (f, y) in held)

    heat = min((0.25 * 1.25**i for i in range(14)), key=loss)
    weights, bias = _fit(rows, len(families))
    return families, weights, bias, heat


@lru_cache
def telling() -> frozenset[str]:
    """Features of licence names that alone make a paragraph anything but ``none``."""
    _, weights, bias, heat = trained()
    named = {f for names in NAMES.values() for name in names for f in features(name)}
    return frozenset(f for f in named if _probabilities(weights, bias, [f], heat)[0] < 0.5)


def _model_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    families, weights, _, _ = trained()
    model = spark.createDataFrame(
        [(f, [round(x, 6) for x in w]) for f, w in sorted(weights.items())],
        "feature string, weights array<double>",
    )
    notices = spark.createDataFrame(
        [(f, sorted(features(t))) for f in families if f != NONE for t in NOTICES[f]],
        "family string, notice array<string>",
    )
    return model, notices


def _literals(values) -> str:
    return ", ".join("'" + f.replace("'", "''") + "'" for f in sorted(values)) or "''"


def paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, line_no (of the first line, from 1), n_lines and the paragraph's text."""
    ends = r"""regexp(right(rtrim(get(l, i - 1)), 3), '[.:;!?]["'')]*$')"""
    goes_on = (
        f"i > 0 and length(rtrim(get(l, i - 1))) >= {WRAPPED} and trim(get(l, i)) != '' and not {ends}"
    )
    # lines are bound once as l, the places where a paragraph begins as s
    cut = f"""transform(array(split(text, '\\n')), l ->
      transform(array(filter(sequence(0, size(l) - 1), i -> not ({goes_on}))), s ->
        transform(s, (from, k) -> named_struct('at', from,
          'n', coalesce(get(s, k + 1), size(l)) - from,
          'text', array_join(slice(l, from + 1, coalesce(get(s, k + 1), size(l)) - from), ' '))))[0])[0]"""
    return (
        docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
        .select("doc_id", F.explode(F.expr(cut)).alias("p"))
        .select(
            "doc_id",
            (F.col("p.at") + 1).cast("bigint").alias("line_no"),
            F.col("p.n").cast("bigint").alias("n_lines"),
            F.col("p.text").alias("paragraph"),
        )
    )


def marked_paragraphs(docs: DataFrame) -> DataFrame:
    """doc_id, line_no, n_lines and hits: the features of the model in a paragraph.

    A paragraph without features is ``none``, and so is one whose only feature is not
    ``telling``.
    """
    _, weights, _, _ = trained()
    found = f"regexp_extract_all(lower(paragraph), '{WORD}', 0)".replace("\\", "\\\\")
    # the words are bound once as w; a column would be worked out anew at each use.
    # Pairs of stop words are in no model, so the filter drops them.
    hits = f"""transform(array({found}), w -> array_sort(array_distinct(filter(
        concat(w, transform(slice(w, 2, greatest(size(w) - 1, 0)), (x, i) -> concat(w[i], ' ', x))),
        f -> f in ({_literals(weights)})))))[0]"""
    return (
        paragraphs(docs)
        .select("doc_id", "line_no", "n_lines", F.expr(hits).alias("hits"))
        .where(f"size(hits) >= 2 or get(hits, 0) in ({_literals(telling())})")
    )


def scan(docs: DataFrame, limit: float = 0.5, agreement: float = 0.5) -> DataFrame:
    """Licence paragraphs in documents: doc_id, line_no, n_lines, family, probability,
    similarity, confirmed.

    ``docs`` has doc_id and text; other columns are ignored, whatever their names. A
    paragraph is reported when ``none`` has a probability under one half. Its family is
    the most probable one (ties: the first by name), or ``unknown`` if that is the class
    of licences without a family or has a calibrated probability under ``limit``.
    Similarity is the largest share of a text of the named family that the paragraph has
    (features of the text; null beside ``unknown``); ``confirmed`` from ``agreement`` on,
    never beside ``unknown``.

    Null and empty texts have no paragraphs with features. Paragraphs repeated in a
    document, repeated documents and documents without an id are reported each. Lines
    count from 1; texts and lines of any length are read whole. Texts are read once:
    what has features of the model is stored, its different sets of features are judged
    once, and the judgements are stored too, so that a set that a third of all
    paragraphs share is split over tasks in the last join. An empty table gives an empty
    result.
    """
    families, _, bias, heat = trained()
    model, notices = _model_tables(docs.sparkSession)
    marked = stored(marked_paragraphs(docs), "licence-marks")
    sets = marked.select("hits").distinct()
    k = len(families)
    sums = (
        sets.select("hits", F.explode("hits").alias("feature"))
        .join(F.broadcast(model), "feature")  # bounded by the training texts
        .groupBy("hits")
        .agg(*[F.round(F.sum(F.col("weights")[i]), 6).alias(f"z{i}") for i in range(k)])
    )
    logits = [
        (F.col(f"z{i}") / F.sqrt(F.size("hits")) + F.lit(round(bias[i], 6))) / F.lit(heat)
        for i in range(k)
    ]
    scored = sums.select("hits", F.array(*logits).alias("z")).select(
        "hits",
        "z",
        F.expr("array_max(slice(z, 2, size(z)))").alias("top"),
        F.expr("aggregate(z, 0D, (s, x) -> s + exp(x - array_max(z)))").alias("total"),
        F.array_max("z").alias("most"),
    )
    named = F.array(*[F.lit(f) for f in families[1:]])
    best = scored.where("exp(z[0] - most) / total < 0.5D").select(
        "hits",
        F.element_at(named, F.expr("array_position(slice(z, 2, size(z)), top)").cast("int")).alias(
            "best"
        ),
        F.expr("exp(top - most) / total").alias("probability"),
    )
    family = F.when(F.col("probability") < limit, UNKNOWN).otherwise(F.col("best"))
    classed = best.select("hits", family.alias("family"), F.round("probability", 6).alias("probability"))
    # compared with the texts of the family, some ten a set at most
    near = (
        classed.join(F.broadcast(notices.where(F.col("family") != UNKNOWN)), "family", "left")
        .select(
            "hits",
            "family",
            "probability",
            (F.size(F.array_intersect("hits", "notice")) / F.size("notice")).alias("share"),
        )
        .groupBy("hits", "family", "probability")
        .agg(F.round(F.max(F.when(F.col("family") != UNKNOWN, F.col("share"))), 6).alias("similarity"))
    )
    judged = stored(
        near.select(
            "*", F.coalesce(F.col("similarity") >= agreement, F.lit(False)).alias("confirmed")
        ),
        "licence-judgements",
    )
    return marked.join(judged, "hits").select(
        "doc_id", "line_no", "n_lines", "family", "probability", "similarity", "confirmed"
    )
