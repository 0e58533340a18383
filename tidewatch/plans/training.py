"""Split, fit, choose a threshold on validation, judge on test."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.operators import attribution as A
from tidewatch.operators import metrics as MT
from tidewatch.operators import models as M
from tidewatch.operators.bootstrap import bootstrap_ci
from tidewatch.operators.clean import normal_rows, seeded_sample, split_summary, stratified_split
from tidewatch.session import settle_wide
from tidewatch.sources.tables import require_columns, write_report


def train(df: DataFrame, raw: list[str], kind: str = "iforest", key: str = "row_id",
          seed: int = 42, max_fpr: float = 0.05, iterations: int = 500, folds: int = 5,
          rows_explained: int = 0, out: str | None = None, **options) -> dict:
    """Frames `splits`, `report`, `intervals`, `folds`, `cv` (and `importance`), plus `bundle`.

    The threshold sees validation rows only; test rows are touched once it is fixed.
    """
    require_columns(df, [*raw, "label", "attack_type"], "no training without")
    rows = settle_wide(stratified_split(df, key, seed=seed), "split")
    part = {s: rows.where(F.col("split") == s) for s in ("train", "validation", "test")}
    normal_rows(part["train"])
    model = M.DetectionPipeline(kind=kind, inputCols=raw, keyCol=key, seed=seed,
                                **options).fit(part["train"])
    scored = {s: M.score_with(model, part[s], kind).select(key, "label", "attack_type", "score")
              for s in ("validation", "test")}
    if kind == "iforest":
        choice = MT.quantile_threshold(scored["validation"], max_fpr)
    else:
        choice = MT.choose_threshold(MT.threshold_table(scored["validation"]), max_fpr)
    threshold = float(choice.first()["threshold"])
    bundle = M.ModelBundle(model, kind, threshold, raw, {
        "rows_learned": "label 0" if kind == "iforest" else "all",
        "seed": seed, "threshold_rule": f"best F1 on validation, FPR at most {max_fpr}"})
    both = scored["validation"].withColumn("split", F.lit("validation")).unionByName(
        scored["test"].withColumn("split", F.lit("test")))
    result = {
        "bundle": bundle,
        "splits": split_summary(rows),
        "report": MT.evaluate(both, threshold, ["split"], kind != "iforest").withColumn(
            "threshold", F.lit(threshold)),
        "intervals": bootstrap_ci(scored["test"], threshold, iterations, seed,
                                  kind != "iforest"),
    }
    if folds > 1:
        result["folds"] = M.cross_validate(part["train"], kind, folds, seed, key, inputCols=raw,
                                           **options)
        result["cv"] = M.cv_summary(result["folds"])
    if rows_explained and kind == "iforest":
        sample = model.transform(seeded_sample(part["validation"], rows_explained, key, seed))
        result["importance"] = A.importance(A.tree_attribution(
            model.stages[-1], sample, M.output_names(sample), key))
    if out:
        bundle.save(f"{out}/model")
        for name, frame in result.items():
            if name != "bundle":
                write_report(frame, f"{out}/{name}", "csv" if name == "importance" else "json")
    return result
