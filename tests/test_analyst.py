from tests.conftest import SF001
from warband.plans import analyst, gold
from warband.registry import silver_of


def test_empty_selection_gives_empty_result(spark):
    s = silver_of(spark, SF001)
    assert analyst.civ_winrates(gold.winrate_civ(s), []).count() == 0
    assert analyst.strategy_winrates(gold.winrate_strat(s), []).count() == 0
    assert analyst.opening_sequences(gold.openings(s), 10, 0, 5000, []).count() == 0


def test_opening_sequence_order_and_ids(spark):
    s = silver_of(spark, SF001)
    op = gold.openings(s, top_n=5)
    seq = analyst.opening_sequences(op, 5, 0, 5000).collect()
    assert seq and all(len(r.activity.split(" → ")) <= 5 for r in seq)
    assert all(len(r.player_id) <= 9 and len(r.match_id) <= 11 for r in seq)
    first = op.where("action_rank = 1").select("match_id", "activity").collect()
    by_match = {r.match_id: r.activity for r in first}
    full = analyst.opening_sequences(op, 5, 0, 5000).collect()
    assert any(by_match.get(r.match_id) == r.activity.split(" → ")[0] for r in full)


def test_age_matrix_column_order(spark):
    s = silver_of(spark, SF001)
    at = gold.age_timings(s)
    m = analyst.age_matrix(at)
    means = {r.activity: r.m for r in at.groupBy("activity").avg("avg_time_mins")
             .withColumnRenamed("avg(avg_time_mins)", "m").collect()}
    assert m.columns[0] == "civilization"
    assert m.columns[1:] == sorted(means, key=lambda a: means[a])


def test_action_step_matrix_fills_zero(spark):
    s = silver_of(spark, SF001)
    wide = analyst.action_step_matrix(gold.openings(s), 12, 0, 5000).collect()
    assert wide and all(r[str(i)] is not None for r in wide for i in range(1, 13))
