from __future__ import annotations

import pytest

import __spark_entry__
from barloom.plans import registry
from compare import same

#: Every query with SQL, but for those that are the same text over the same panels as another of their family.
SOME = [
    *("feature_ic src_1 src_2 src_3 src_6 src_7 snk_1 snk_2 snk_3 snk_4 snk_5 prj_2 prj_3 prj_5 prj_9 prj_10 prj_12 prj_12_resolved prj_13 prj_14 prj_15 prj_16 prj_17 prj_18 prj_19").split(),
    *("jn_1 ag_1 ag_6 ag_7 ag_8 ag_13 ag_20 ag_22 ft_9 ft_12 ft_14 ft_16 ft_17 ft_28 ft_35 ft_55 ft_59 ft_60 ft_61 ft_61_ema ft_62 rg_6").split(),
    *("tg_1 tg_2 tg_6 tg_7 tg_9 tg_12 tg_15 tg_16 tg_17 csx_1 csx_2 csx_6 csx_7 csx_8 csx_11 csx_12 csx_16 csx_17 set_4").split(),
    *("csx_17_windows csx_17_ahead csx_17_checks csx_12_fences csx_12_extremes qa_5_matrix qa_13_stages trd_1_series trd_1_breaks drf_2_changes ag_18_consensus").split(),
    *("src_1_mixed src_1_rounding src_4_batch src_5_universe src_5_audit src_6_texts prj_2_policies jn_3 jn_3_changes qa_1_intervals qa_4_copies ag_21_winners ag_23_candidates rte_1_routes rte_2_routes dec_1_rules ft_60_indicators stb_1_pairs stb_1_summary ev_4_classes qa_17_rules").split(),
    *("ag_3_timeframe ag_3_steps ag_6_coverage prj_11_sanity csx_9_splits csx_9_reduced csx_10_parts csx_15_frame csx_18_gated csx_18_summary qa_6_scores drf_1_metrics stb_4_runs qa_16_columns ag_12_columns").split(),
    *("qa_1 qa_5 qa_11 qa_12 ev_1 ev_3 ev_5 stb_1 trd_1 rte_1 str_1 str_2 str_3 str_4").split(),
]


@pytest.mark.parametrize("name", SOME)
def test_rows_equal_sql(spark, sf_dir, name):
    same(spark, sf_dir, registry.QUERIES[name], registry.SQL[name])


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["feature", "n_ts", "mean_ic", "ic_ir"]
