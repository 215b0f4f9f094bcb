"""Staged classification, verdicts, and labels along several axes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.functions.text import lexicon_hits, signature_of_text
from catalith.operators.state import replace_partition
from catalith.sources.numbering import short

#: Confidence of each stage, and the label of what no lexicon names.
SIGNED, LED, UNNAMED, JUDGED, GENERAL, REVIEW = 1.0, 0.9, 0.7, 0.6, "general", "review"


def cascade(rows: DataFrame, lexicons: dict[str, list[str]], *, text: str = "text", rules: dict[str, list[Callable[[Column], Column]]] | None = None, verdicts: DataFrame | None = None, key: str = "asset_id", policy: str | None = None) -> DataFrame:
    """rows with label, confidence, stage, signature, policy_version, the signature found for each label (stage1_scores) and the
    hit counts of each lexicon (stage2_scores).

    Stage 1: of each label's rules, which name a signature or nothing, the first that names one counts; it decides if no other
    label has one too. Stage 2: the lexicon with the most distinct hits wins from two
    hits on when it leads the next one by one at least (ties in the order given); no hit at all is general. Stage 3: a
    verdict (key, label) from outside in the label set, else review. Only columns are added; what stages 1 and 2 leave open
    is all that a verdict needs to be made for.
    """
    names = list(lexicons)
    rules = rules or {"medical": [signature_of_text]}
    found = F.create_map(*[x for label, own in rules.items() for x in (F.lit(label), F.coalesce(*[rule(F.col(text)) for rule in own]))])
    counts = rows.withColumn("stage1_scores", F.map_filter(found, lambda _, v: v.isNotNull()))
    alone = F.size("stage1_scores") == 1
    counts = counts.withColumns({"signature": F.when(alone, F.get(F.map_values("stage1_scores"), 0)), "policy_version": F.lit(policy).cast("string")})
    for name in names:
        counts = counts.withColumn(f"_n_{name}", F.size(lexicon_hits(F.col(text), lexicons[name])))
    order = F.array_sort(F.array(*[F.struct((-F.col(f"_n_{n}")).alias("n"), F.lit(i).alias("i"), F.lit(n).alias("name")) for i, n in enumerate(names)]))
    top, second = F.element_at(order, 1), (F.element_at(order, 2)["n"] if len(names) > 1 else F.lit(0))
    own = F.when(alone, F.get(F.map_keys("stage1_scores"), 0))
    stage2 = F.when(top["n"] == 0, F.struct(F.lit(GENERAL).alias("label"), F.lit(UNNAMED).alias("confidence"))).when((top["n"] <= -2) & (second - top["n"] >= 1), F.struct(top["name"].alias("label"), F.lit(LED).alias("confidence")))
    out = counts.withColumns({"_one": own, "_two": stage2, "stage2_scores": F.create_map(*[x for n in names for x in (F.lit(n), F.col(f"_n_{n}"))])})
    if verdicts is not None:
        out = out.join(verdicts.select(key, F.lower(F.trim("label")).alias("_said")), key, "left")
    else:
        out = out.withColumn("_said", F.lit(None).cast("string"))
    known = F.coalesce(F.col("_said").isin(*names, GENERAL), F.lit(False))
    label = F.coalesce("_one", F.col("_two.label"), F.when(known, F.col("_said")), F.lit(REVIEW))
    conf = F.when(F.col("_one").isNotNull(), SIGNED).otherwise(F.coalesce(F.col("_two.confidence"), F.when(known, JUDGED).otherwise(0.0)))
    stage = F.when(F.col("_one").isNotNull(), 1).when(F.col("_two").isNotNull(), 2).otherwise(3)
    return out.withColumns({"label": label, "confidence": conf, "stage": stage}).drop("_one", "_two", "_said", *[f"_n_{n}" for n in names])


def valid_verdict(json: Column, labels: list[str]) -> Column:
    """The label of a JSON answer when it is in the closed set, trimmed and in lower case; review otherwise."""
    label = F.lower(F.trim(F.get_json_object(F.when(F.trim(json).startswith("{"), json), "$.label")))
    return F.when(label.isin(*labels), label).otherwise(REVIEW)


def planned_deferral(rows: DataFrame, extractors: list[str]) -> DataFrame:
    """What a signature decided but no extractor can read is deferred with reason <label>_format:<signature>."""
    due = (F.col("stage") == 1) & ~F.col("signature").isin(*extractors)
    return rows.withColumns({"status": F.when(due, "deferred").otherwise(F.col("status")), "status_reason": F.when(due, F.concat("label", F.lit("_format:"), "signature"))})


def lexicon_judge(skills: dict[str, dict[str, list[str]]]) -> Callable[[DataFrame, str], DataFrame]:
    """The default judge: (skill, label, text) pairs by the lexicon of each label; no label is unassigned."""

    def judge(rows: DataFrame, text: str) -> DataFrame:
        every = []
        for skill, labels in skills.items():
            found = F.filter(F.array(*[F.when(F.size(lexicon_hits(F.col(text), terms)) > 0, F.lit(label)) for label, terms in labels.items()]), lambda x: x.isNotNull())
            every.append(F.struct(F.lit(skill).alias("skill_code"), F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("unassigned"))).alias("labels")))
        flat = rows.select("asset_id", F.explode(F.array(*every)).alias("j"))
        return flat.select("asset_id", "j.skill_code", F.explode("j.labels").alias("label_code"))

    return judge


def pending(assets: DataFrame, skills: DataFrame, state: DataFrame) -> DataFrame:
    """(asset_id, skill_code, skill_version) not judged yet, or judged by an older version. Skills are a short list."""
    have = state.groupBy("asset_id", "skill_code").agg(F.max("skill_version").alias("_v"))
    every = assets.select("asset_id").crossJoin(short(skills.select("skill_code", "skill_version")))
    return every.join(have, ["asset_id", "skill_code"], "left").filter(F.col("_v").isNull() | (F.col("_v") < F.col("skill_version"))).drop("_v")


def label_axes(state: DataFrame, due: DataFrame, judged: DataFrame) -> DataFrame:
    """State after a pass: all rows of a judged (asset, skill) give way to the new ones. A pair without a judgement failed and
    keeps its rows."""
    new = due.join(judged, ["asset_id", "skill_code"]).select("asset_id", "skill_code", "label_code", "skill_version")
    return replace_partition(state, new, ["asset_id", "skill_code"])


def axis_report(due: DataFrame, judged: DataFrame, had: DataFrame) -> DataFrame:
    """One row a skill: targets, judged, failed, created, updated, assigned labels and the share of unassigned, to four digits."""
    done = judged.groupBy("asset_id", "skill_code").agg(F.count_if(F.col("label_code") != "unassigned").alias("n"))
    old = had.select("asset_id", "skill_code").distinct().withColumn("_had", F.lit(True))
    rows = due.join(done, ["asset_id", "skill_code"], "left").join(old, ["asset_id", "skill_code"], "left")
    is_done, was = F.col("n").isNotNull(), F.coalesce("_had", F.lit(False))
    return rows.groupBy("skill_code").agg(
        F.count("*").alias("targets"), F.count_if(is_done).alias("judged"), F.count_if(~is_done).alias("failed"), F.count_if(is_done & ~was).alias("created"), F.count_if(is_done & was).alias("updated"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("labels"), F.round(F.try_divide(F.count_if(is_done & (F.col("n") == 0)), F.count_if(is_done)), 4).alias("unassigned_ratio"),
    )


def label_distribution(judged: DataFrame) -> DataFrame:
    return judged.groupBy("skill_code", "label_code").agg(F.count("*").alias("n"))


def failure_histogram(rows: DataFrame, error: str = "error") -> DataFrame:
    """Failures by the name of their kind: what stands before the first colon."""
    return rows.filter(F.col(error).isNotNull()).groupBy(F.regexp_extract(error, r"^\s*([^:\s]+)", 1).alias("reason")).agg(F.count("*").alias("n"))


def dispatch(assets: DataFrame, handlers: dict[str, Callable[[DataFrame], DataFrame]]) -> tuple[DataFrame, DataFrame]:
    """Rows of each modality through its own handler, united by name; the rest, which no handler takes."""
    outs = [handler(assets.filter(F.col("modality") == m)) for m, handler in handlers.items()]
    united = outs[0]
    for out in outs[1:]:
        united = united.unionByName(out, allowMissingColumns=True)
    return united, assets.filter(~F.coalesce(F.col("modality").isin(*handlers), F.lit(False)))
