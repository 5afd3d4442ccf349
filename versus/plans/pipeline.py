"""End-to-end feature builds for both scopes (#117, #118).

merge -> clean -> group split -> enrich (features, encoders fitted on train)
-> candidate selection -> correlation / VIF / scaling fitted on train ->
one transformed frame ``[ids, split, features..., win]`` written partitioned
by (scope, split) plus gzip CSV per split and a JSON summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import KEYS, MIN_DURATION_SECONDS
from ..functions.columns import select_candidates
from ..operators import encoders as EN
from ..operators import features as FE
from ..operators import selection as SEL
from ..operators import split as SP
from ..operators.clean import assert_group_frame, clean_dataset
from ..operators.relational import assign_sides
from ..operators.training import write_summary
from ..sources import io as IO
from .postgame import members_of, postgame_sides
from .pregame import CODES, add_pregame_features, pregame_sides
from ..session import cut_lineage

PREGAME_SELECTED = [
    "team_avg_champ_wr", "team_min_champ_wr", "team_max_champ_wr", "team_std_champ_wr", "team_champ_wr_span",
    "team_avg_pick_rate", "team_max_pick_rate", "team_min_pick_rate", "team_avg_champ_wr_diff_vs_opp",
    "team_max_champ_wr_diff_vs_opp", "team_avg_pick_rate_diff_vs_opp", "avg_banned_champ_wr",
    "max_banned_champ_wr", "draft_size", "has_full_draft", "unique_champion_count", "role_known_count",
    "role_diversity", "n_bans", "has_ban_data", "is_blue_side", "platform_code", "season_code"]


def _write(spark: SparkSession, out: DataFrame, summary: dict, out_dir: str, scope: str) -> DataFrame:
    IO.write_splits(out, f"{out_dir}/features", scope)
    for s in ("train", "val", "test"):
        IO.write_csv(out.where(F.col("split") == s).drop("split"), f"{out_dir}/{scope}_{s}_features.csv.gz")
    write_summary(spark, summary, f"{out_dir}/{scope}_feature_engineering_summary.json")
    return spark.read.parquet(f"{out_dir}/features").where(F.col("scope") == scope)


def build_postgame_features(spark: SparkSession, t: dict, out_dir: str, slots_per_side: int = 5,
                            target: str = "win", binary: Sequence[str] | None = None) -> tuple[DataFrame, dict]:
    """``binary`` names the binary statistics if they are known (else one more pass over the members finds them)."""
    merged = postgame_sides(assign_sides(members_of(t), slots_per_side), t["matches"], t["teamstats"], binary)
    curated = cut_lineage(SP.split_grouped(clean_dataset(merged, MIN_DURATION_SECONDS, never_null=KEYS)))
    assert_group_frame(curated, "curated post-game frame")
    enriched = FE.team_features(FE.player_features(curated))
    enc = EN.fit_target_encoding(enriched.where(F.col("split") == "train"), target=target)
    enriched = EN.apply_encoding(enriched, enc)
    candidates = select_candidates(enriched.drop("split"), target)
    out, _, summary = SEL.fit_transform_splits(enriched, candidates, target)
    summary.update({"scope": "postgame", "champion_encoding_columns": enc.columns,
                    "champion_encoding_prior": enc.prior})
    return _write(spark, out, summary, out_dir, "postgame"), summary


def build_pregame_features(spark: SparkSession, t: dict, out_dir: str, slots_per_side: int = 5,
                           target: str = "win") -> tuple[DataFrame, dict]:
    merged = pregame_sides(members_of(t, ["id", "win"]), t["matches"], t["teambans"], slots_per_side)
    curated = cut_lineage(SP.split_grouped(clean_dataset(merged, MIN_DURATION_SECONDS, never_null=KEYS)))
    assert_group_frame(curated, "curated pre-game frame")
    train = curated.where(F.col("split") == "train")
    champ = [f"champion_{i}" for i in range(1, 6) if f"champion_{i}" in curated.columns]
    te = EN.fit_target_encoding(train, target=target)
    pick = EN.fit_pick_rate(train, champ)
    enriched = add_pregame_features(curated, te, pick, EN.fit_codes(train, CODES))
    selected = [c for c in ([f"{c}_winrate_te" for c in champ] + [f"{c}_pick_rate" for c in champ]
                            + PREGAME_SELECTED) if c in enriched.columns]
    out, _, summary = SEL.fit_transform_splits(enriched, selected, target, min_features_after_vif=5)
    summary.update({"scope": "pregame", "champion_encoding_columns": te.columns,
                    "champion_encoding_prior": te.prior, "champion_pick_rate_prior": pick.prior})
    return _write(spark, out, summary, out_dir, "pregame"), summary
