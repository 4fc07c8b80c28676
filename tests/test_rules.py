"""Hand-built edge tables for labels, ledger, gates and statistics."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallywatch.functions import labels, ledger, standard, timeparts
from tallywatch.operators import quality, stats, windows
from tests.conftest import column, rows

MONEY = "amount", "oldbalanceOrg", "newbalanceOrig", "oldbalanceDest", "newbalanceDest"


def txns(spark, data, **constants):
    """Rows from dicts; missing money columns are 0."""
    full = [
        {
            "txn_id": i,
            "step": 1,
            "type": "TRANSFER",
            "nameOrig": "C1",
            "nameDest": "M1",
            **{m: "0" for m in MONEY},
            **constants,
            **row,
        }
        for i, row in enumerate(data)
    ]
    schema = "txn_id long, step int, type string, nameOrig string, nameDest string, " + ", ".join(
        f"{m} string" for m in MONEY
    )
    df = spark.createDataFrame([tuple(r[c] for c in
        ("txn_id", "step", "type", "nameOrig", "nameDest", *MONEY)) for r in full], schema)
    return df.withColumns({m: F.col(m).cast("decimal(18,2)") for m in MONEY})


def amounts(spark, *values, **constants):
    return txns(spark, [{"amount": v} for v in values], **constants)


EDGES = ("0.00", "-5.00", "0.50", "100.00", "200000.00", "200000.01", "500000.01", None)


def test_normalize_cleans_before_labels(spark):
    df = txns(spark, [{"type": " transfer ", "amount": "200000.01"}])
    assert column(labels.label_risk(standard.normalize(df)), "risk_score") == ["High Risk"]


def test_unparsable_values_become_null(spark):
    raw = spark.createDataFrame([("x", "7.5", "true", "maybe")], "step string, amount string, isFraud string, isFlaggedFraud string")
    row = standard.normalize(raw).first()
    assert (row.step, row.amount, row.isFraud, row.isFlaggedFraud) == (None, Decimal("7.50"), True, None)


def test_risk_edges(spark):
    out = labels.label_risk(amounts(spark, *EDGES))
    assert column(out, "risk_score") == [
        "Low Risk", "Low Risk", "Low Risk", "Low Risk", "Medium Risk", "High Risk", "High Risk",
        "Low Risk",
    ]
    assert column(out, "is_suspicious_flag") == [0, 1, 0, 0, 0, 0, 0, 0]
    assert column(out, "fraud_pattern")[3:5] == ["Normal", "Critical - Account Emptied"]
    assert column(out, "is_overdraft") == [False, False, True, True, True, True, True, None]


def test_segment_edges(spark):
    out = labels.label_segment(amounts(spark, "999.99", "1000", "50000", "100000", "500000", "500000.01"))
    assert column(out, "segment") == [
        "Retail", "Professional", "Institutional", "Institutional",
        "Ultra High Net Worth", "Ultra High Net Worth",
    ]
    assert column(out, "customer_segment") == [
        "Standard", "Standard", "Standard", "Standard", "Gold", "Platinum",
    ]


def test_number_edges(spark):
    out = labels.label_number(amounts(spark, *EDGES))
    assert column(out, "is_round_number") == [1, 0, 0, 1, 1, 0, 0, 0]
    assert column(out, "first_digit") == [0, None, 0, 1, 2, 2, 5, None]


def test_types_and_destinations(spark):
    df = txns(spark, [{"type": t} for t in ("TRANSFER", "CASH_IN", "DEBIT", "OTHER", None)])
    out = labels.label_type(df)
    assert column(out, "fund_direction") == ["Outbound", "Inbound", "Outbound", "Internal", "Internal"]
    assert column(out, "type_risk_level") == ["High", "Low", "Low", "Low", "Low"]
    dest = labels.label_dest(txns(spark, [
        {"amount": "1"}, {"amount": "0"}, {"amount": "1", "newbalanceDest": "2", "nameDest": "C1"},
    ]))
    assert column(dest, "is_new_destination") == [True, False, False]
    assert column(dest, "is_untracked_destination") == [True, True, False]
    assert column(dest, "is_merchant_dest") == [True, True, False]


def test_drain_limit_is_exclusive(spark):
    out = labels.drain(txns(spark, [
        {"amount": "90", "oldbalanceOrg": "100"},
        {"amount": "90.01", "oldbalanceOrg": "100"},
        {"amount": "5", "oldbalanceOrg": "0"},
        {"amount": None, "oldbalanceOrg": "100"},
    ]))
    assert column(out, "is_drain_event") == [0, 1, 0, 0]
    assert column(out, "balance_drain_ratio") == [90.0, 90.01, 0.0, None]


def test_ledger_edges(spark):
    """Gaps of 0, 0.01, 0.99, 1.00, gap = amount, amount 0, unknown."""
    data = [
        {"amount": "10", "oldbalanceOrg": "10", "newbalanceOrig": "0"},
        {"amount": "10", "oldbalanceOrg": "10", "newbalanceOrig": "0.01"},
        {"amount": "10", "oldbalanceOrg": "10", "newbalanceOrig": "0.99"},
        {"amount": "10", "oldbalanceOrg": "10", "newbalanceOrig": "1.00"},
        {"amount": "10", "oldbalanceOrg": "10", "newbalanceOrig": "10"},
        {"amount": "0", "oldbalanceOrg": "10", "newbalanceOrig": "3"},
        {"amount": None},
    ]
    out = ledger.quality_tier(ledger.ledger_gaps(txns(spark, data)))
    assert [t[0] for t in column(out, "quality_tier")] == list("ABBDCDD")
    assert column(out, "is_math_correct") == [1, 0, 0, 0, 0, 0, 0]
    assert column(out, "relative_origin_error") == [0, 0, 0, 0, 1, 0, 0]
    report = rows(ledger.audit_report(out))
    assert [r["record_count"] for r in report] == [1, 2, 1, 3]


def test_mask(spark):
    df = txns(spark, [{"nameOrig": " c1 "}, {"nameOrig": "C1"}, {"nameOrig": None}])
    out = standard.mask(df, "s")
    a, b, c = column(out, "nameOrig_hashed")
    assert a == b and len(a) == 64 and c is None
    assert not {"nameOrig", "nameDest"} & set(out.columns)
    assert column(standard.mask(df, "other"), "nameOrig_hashed")[0] != a
    with pytest.raises(TypeError):
        standard.mask(df)


# -- gates ------------------------------------------------------------------------


@pytest.mark.parametrize("nulls,passes", [(0, True), (1, True), (2, False)])
def test_null_ratio_gate(spark, nulls, passes):
    df = amounts(spark, *[None] * nulls, *["1"] * (10 - nulls))
    report = quality.gate(df)
    assert report.first()["passes"] is passes
    if passes:
        quality.enforce_gate(report)
    else:
        with pytest.raises(quality.IntegrityError, match="20.00%"):
            quality.enforce_gate(report)


def test_gate_rejects_empty_input(spark):
    with pytest.raises(quality.IntegrityError, match="empty"):
        quality.enforce_gate(quality.gate(amounts(spark, "1").limit(0)))


def test_split_keeps_every_row(spark):
    df = txns(spark, [
        {"amount": "1"}, {"amount": None}, {"amount": "0"}, {"amount": "-1"}, {"nameOrig": None, "amount": "1"},
        {"nameOrig": None, "amount": None}, {"step": None, "amount": "1"}, {"type": None, "amount": "1"},
    ])
    masked = standard.mask(df, "s")
    kept, rejected = quality.split_valid(masked, ["step", "type"])
    assert column(kept, "txn_id") == [0]
    assert column(rejected, "quarantine_reason") == [
        "Missing Amount", "Negative or Zero Amount", "Negative or Zero Amount",
        "Missing Originator Identity", "Missing Amount", "Missing Surrogate Key",
        "Missing Surrogate Key",
    ]
    yes, no = quality.split_by(df, F.col("amount") > 0)
    assert yes.count() + no.count() == 8 and yes.count() == 4


def test_logical_errors_and_notes(spark):
    df = txns(spark, [
        {"step": 0}, {"step": 1}, {"step": 1000}, {"step": 1001},
        {"newbalanceOrig": "5"}, {"newbalanceOrig": "5", "step": 0}, {"step": None},
    ])
    out = quality.audit_note(quality.logical_errors(df))
    assert column(out, "has_logical_error") == [1, 0, 0, 1, 1, 1, 0]
    notes = column(out, "audit_note")
    assert notes[1] == "" and " | " in notes[5] and notes[6] == ""


def test_score_bounds(spark):
    df = spark.createDataFrame([(0, -1), (1, 0), (2, 100), (3, 101), (4, None)], "txn_id int, total_risk_score int")
    assert column(quality.score_bounds(df), "risk_score_out_of_bounds") == [1, 0, 0, 1, 0]


def test_zscore_without_variance(spark):
    df = txns(spark, [
        {"type": "A", "amount": "1"}, {"type": "B", "amount": "2"}, {"type": "B", "amount": "2"},
        {"type": "C", "amount": "1"}, {"type": "C", "amount": "3"}, {"type": None, "amount": "3"},
    ])
    z = stats.zscore(df)
    assert [v if v is None else round(v, 4) for v in column(z, "z_score")] == [
        None, None, None, -0.7071, 0.7071, None,
    ]
    kept, failed = quality.split_sane(z)
    assert kept.count() == 2 and failed.count() == 4
    assert set(column(failed, "audit_reason")) == {"no variance"}


def test_reconcile(spark):
    silver = standard.mask(txns(spark, [{"amount": "5"}, {"amount": "7", "nameOrig": "C2"}, {"amount": None}]), "s")
    fact = silver.filter("amount > 0")
    report = quality.reconcile(silver, fact, silver).first()
    assert (report.silver_rows, report.fact_rows, report.orphan_rows, report.filtered_rows) == (3, 2, 0, 1)
    assert report.amount_diff == 0 and report.passes
    bad = quality.reconcile(fact, silver, silver.filter("txn_id = 0"))
    assert bad.first().orphan_rows == 1
    with pytest.raises(quality.IntegrityError):
        quality.enforce(bad)
    empty = quality.reconcile(silver.limit(0), fact.limit(0), silver).first()
    assert empty.passes and empty.silver_amount == 0


def test_duplicates(spark):
    df = txns(spark, [{"step": 1}, {"step": 1}, {"step": 2}])
    assert rows(quality.duplicate_keys(df, ["step"])) == [{"step": 1, "n": 2}]
    assert quality.has_duplicates(df, ["step"]) and not quality.has_duplicates(df, ["txn_id"])
    assert column(quality.dedupe(df, ["step"], ["txn_id"]), "txn_id") == [0, 2]


# -- windows ------------------------------------------------------------------------


def test_ties_share_range_frames_only(spark):
    df = standard.mask(amounts(spark, "1", "2", "4"), "s")
    out = windows.outflow(df)
    assert column(out, "running_total_outflow") == [7, 7, 7]
    assert column(out, "cumulative_outflow") == [1, 3, 7]


def test_velocity_frame_edge(spark):
    df = standard.mask(txns(spark, [{"step": s, "amount": "1"} for s in (1, 24, 25, 48)]), "s")
    assert column(windows.velocity(df), "txns_last_24h") == [1, 2, 2, 2]
    assert column(windows.velocity(df, hours=100), "txns_last_24h") == [1, 2, 3, 4]


def test_integrity_status_follows_failures(spark):
    bad = {"amount": "1", "oldbalanceOrg": "9", "newbalanceOrig": "9"}
    good = {"amount": "1", "oldbalanceOrg": "9", "newbalanceOrig": "8"}
    seq = [good, good, good, bad, bad, bad]
    df = standard.mask(txns(spark, [{**r, "step": i} for i, r in enumerate(seq)]), "s")
    out = windows.integrity_history(df)
    assert column(out, "account_audit_status") == ["Clean"] * 5 + ["Flagged for Audit"]
    assert column(out, "cumulative_integrity_passes") == [1, 2, 3, 3, 3, 3]


def test_session_gaps(spark):
    """59 and 60 minutes continue a session, 61 starts the next."""
    df = spark.sql("""select * from values
        (0, 'a', timestamp_ntz'2025-01-01 00:00:00'), (1, 'a', timestamp_ntz'2025-01-01 00:59:00'),
        (2, 'a', timestamp_ntz'2025-01-01 01:59:00'), (3, 'a', timestamp_ntz'2025-01-01 03:00:00')
        as t(txn_id, nameOrig_hashed, ts)""")
    assert column(windows.sessionize(df), "session_id") == [0, 0, 0, 1]


def test_unknown_feature_is_an_error(spark):
    with pytest.raises(ValueError, match="unknown"):
        windows.behavior(amounts(spark, "1"), ["tempo"])


def test_time_parts_edges(spark):
    df = txns(spark, [{"step": s} for s in (1, 24, 25, 744)])
    out = timeparts.time_parts(df)
    assert column(out, "sim_hour") == [0, 23, 0, 23] == column(out, "cal_hour")
    assert column(out, "hour_of_day") == [1, 0, 1, 0]
    assert column(out, "sim_day") == [1, 1, 2, 3] and column(out, "day_of_week") == [1, 2, 2, 4]
    assert column(out, "cal_dow") == [4, 4, 5, 6]
