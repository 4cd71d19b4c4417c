"""End-to-end flows of the reference, as calls of library operators.

The reference runs one Python process per stage and hands CSV files
between them; here a flow is a chain of DataFrame functions, and stage
outputs stay DataFrames (written once with ``materialize`` where several
later jobs read them).

* :func:`magic_lookups`   — value-association lookups without / with the
  extra ("old") source.
* :func:`white_list`      — labels transferred to rows to score that equal a
  labelled row on every match key (null equals null).
* :func:`build_features`  — the per-row feature block (digits, flags, ratios,
  row statistics, lookups, group statistics) in a handful of projections and
  one aggregate per key.
* :func:`stacked_prediction` — out-of-fold model on the features (old rows in
  every training fold), its probabilities as features of a second one,
  arg-max class, label map back, override by the white list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import numeric as N
from tessera.functions import rows as RW
from tessera.ml import models
from tessera.operators import aggs, clean, mine, relate
from tessera.sources.store import materialize


#: The multiples (in cents) that deltas of amounts are tested for.
DELTA_MULTIPLES = (5, 10, 15, 27, 30, 50, 100, 500, 6000)


def magic_lookups(train: DataFrame, test: DataFrame, old: DataFrame | None, match_keys: Sequence[str],
                  fee_cols: Sequence[str], order: Sequence[Column | str], min_count: int = 10
                  ) -> tuple[DataFrame, DataFrame | None]:
    """(lookup without old rows, lookup with old rows).

    Rows of train ∪ test are deduplicated on ``match_keys`` (earlier source
    first, then ``order``) before mining; the second lookup adds the old
    source to that deduplicated frame and deduplicates again.
    """
    base = relate.union_dedup_prefer_first([train, test], match_keys, order)
    exclude = mine.mine_pair_lookup(base, fee_cols, min_count=min_count)
    include = None
    if old is not None:
        both = relate.union_dedup_prefer_first([base, old], match_keys, order)
        include = mine.mine_pair_lookup(both, fee_cols, min_count=min_count)
    return exclude, include


def white_list(train: DataFrame, test: DataFrame, match_keys: Sequence[str], id_col: str, label: str,
               order: Sequence[Column | str], sentinel=clean.SENTINEL_LABEL) -> DataFrame:
    """(id of a row to score, transferred label)."""
    labelled = clean.filter_sentinel(train, label, sentinel)
    return relate.exact_match_transfer(test, labelled, match_keys, id_col, label, order)


def build_features(df: DataFrame, fee_cols: Sequence[str], lookup: DataFrame | None = None,
                   size_cols: Sequence[str] = (), group_key: str | None = None,
                   group_values: Sequence[str] = ()) -> DataFrame:
    """Per-row features over the amount columns ``fee_cols``.

    One projection for the row-wise block (minimum, digits, flags, deltas,
    ratios, row statistics), then the lookup joins, the per-value counts and
    one aggregate per group key joined back.
    """
    fmin = "fee_min"
    d = df.withColumn(fmin, RW.row_min(fee_cols))
    cols = list(fee_cols) + [fmin]
    block = {}
    for c in cols:
        ip = N.int_part(c, -1)
        dec = N.decimal_cents(c)
        block.update({
            f"{c}_int": ip, f"{c}_int_last": F.pmod(ip, F.lit(10)), f"{c}_decimal": dec,
            f"{c}_decimal_is_0": N.is_zero(dec), f"{c}_decimal_is_5": (F.pmod(dec, F.lit(5)) == 0).cast("int"),
            f"{c}_decimal_last": F.pmod(dec, F.lit(10)), f"{c}_decimal_div5": N.floor_band(dec, 5),
            f"{c}_extra_fee": N.overage(c),
            f"{c}_27perMB": N.multiple_of(N.overage(c), 27.0), f"{c}_15perMB": N.multiple_of(N.overage(c), 15.0),
        })
    for a, b in zip(fee_cols[1:], fee_cols[:-1]):
        cents = F.coalesce(F.rint((F.col(a) - F.col(b)) * 100.0), F.lit(999999.9)).cast("bigint")
        name = f"{a}_{b}_delta_cents"
        block[name] = cents
        for k in DELTA_MULTIPLES:
            block[f"{name}_is_{k}"] = N.multiple_of(cents, k)
        block[f"{a}_{b}_ratio"] = N.ratio(a, b, 0.00001)
    block.update({"fee_sum": RW.row_sum(fee_cols), "fee_var": RW.row_var(fee_cols), "fee_max": RW.row_max(fee_cols),
                  "fee_unum": RW.row_nunique(fee_cols), "fee_second_min": RW.row_second_min(fee_cols),
                  "fee_extra": RW.row_sum(fee_cols) - F.lit(float(len(fee_cols))) * F.col(fmin)})
    d = d.withColumns(block)
    if lookup is not None:
        # lookup keys are cents (exact integers), never float equality
        lk = materialize(lookup.select("first", "second"), "lookup")  # read once per column
        for c in cols:
            d = d.withColumn(f"__{c}_cents", F.rint(F.col(c) * 100.0).cast("bigint"))
            d = d.join(lk.withColumnsRenamed({"first": f"__{c}_cents", "second": f"{c}_most"}),
                       on=f"__{c}_cents", how="left").drop(f"__{c}_cents")
    for c in size_cols:
        d = aggs.group_size(d, [c])
    if group_key:
        for v in group_values:
            d = aggs.group_stats(d, [group_key], v, ("min", "max", "mean", "var"))
        d = aggs.group_deviation(d, group_key, list(group_values))
    return d


def stacked_prediction(train: DataFrame, test: DataFrame, features: Sequence[str], label: str, key: str,
                       classes: Sequence, overrides: DataFrame | None = None, estimator=None,
                       fold: str = "fold", old: DataFrame | None = None,
                       final_features: Sequence[str] | None = None) -> DataFrame:
    """Two levels of out-of-fold models, then overrides.

    The first model is fitted fold by fold on ``train`` with the rows of
    ``old`` appended to every training fold; its out-of-fold probabilities
    (for ``test``: the folds' mean) are joined to the rows as features of the
    second model, which is fitted on ``train``.  The predicted class of a
    ``test`` row is the arg-max of the second model, mapped back to the label;
    listed ids are overridden.  Returns (key, label)."""
    idx = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(c), F.lit(i))])
    own = train.withColumn("__y", F.element_at(idx, F.col(label)))
    own = materialize(own, "stack-train")
    first_rows = own
    if old is not None:
        extra = old.withColumn("__y", F.element_at(idx, F.col(label))).withColumn(fold, F.lit(-1))
        first_rows = relate.union_by_name([own, extra.select(*own.columns)])
    first = models.oof_classify(first_rows, features, "__y", fold, key, len(classes), test, estimator)
    oof, scored = materialize(first.oof, "stack-oof"), materialize(first.scored, "stack-scored")
    final = models.stacking(own, [oof], key, list(final_features or features), "__y", fold, len(classes),
                            test, [scored], estimator)
    probs = [f"class_{i}" for i in range(len(classes))]
    back = F.create_map(*[x for i, c in enumerate(classes) for x in (F.lit(i), F.lit(c))])
    pred = final.scored.select(key, F.element_at(back, RW.argmax(probs)).alias(label))
    if overrides is not None:
        pred = relate.override_join(pred, overrides, key, label)
    return pred
