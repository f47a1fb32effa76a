"""Shape of the plans, skew, uniqueness, and properties of the combined table."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from payscope import FAMILIES, Options, assemble_features, family_features, tune
from payscope import fixed_values as V
from payscope.functions.text import Matcher, spelled_out
from payscope.operators import frequency
from payscope.operators.families import top_k
from payscope.operators.family import Family
from payscope.plans.assemble import key_counts
from payscope.sources import derived
from payscope.sources.schema import ID
from payscope.sources.tables import (
    read_payments, scratch_path, write_features, write_payments_bucketed,
)
from tests.conftest import plan_text


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """Derived payments as stored parquet, so plans start at a scan."""
    tune(spark)
    path = str(tmp_path_factory.mktemp("payments") / "p")
    payments = derived.payments(spark, sf_dir)
    payments = payments.withColumns(
        {c: F.col(c).cast("timestamp") for c in ("PaymentDate", "SettledDate")}
    )
    payments.write.parquet(path)
    return read_payments(spark, path)


@pytest.fixture(scope="module")
def skewed(make_payments):
    """Three large keys, one of them blank, and many small ones."""
    names = ["Hot Name"] * 100 + [None] * 90 + ["  "] * 10 + [f"Name {i % 40}" for i in range(100)]
    return make_payments(
        [
            {"Payment_CustomerName": n, "RemoteIP": "10.0.0.1" if i % 3 else f"9.9.9.{i % 50}",
             "PaymentSourceDesc": "IVR" if i % 3 else f"Odd {i % 7}", "CustomerID": str(i % 11),
             "Partner": None if i % 3 == 0 else "Oracle"}
            for i, n in enumerate(names)
        ]
    )


def test_skewed_frequencies_match_a_plain_count(skewed):
    rows = skewed.select("Payment_CustomerName").collect()
    key = lambda n: " ".join((n or "").split()).upper()
    expected = Counter(key(r[0]) for r in rows)
    for hot_rows in (0, 1, 5, 50, 10_000):
        found = family_features(skewed, "name", options=Options(hot_rows=hot_rows)).collect()
        assert len(found) == len(rows)
        assert all(r.name_frequency == expected[key(r.Payment_CustomerName)] for r in found)


def test_number_of_hot_keys_is_bounded(skewed, monkeypatch):
    """However low hot_rows is, only keys on one row in MAX_HOT_KEYS or more become hot."""
    plain = family_features(skewed, "name", options=Options(hot_rows=0)).orderBy(ID).collect()
    monkeypatch.setattr(frequency, "MAX_HOT_KEYS", 4)
    stats = FAMILIES["name"].stats[0]
    source = skewed.select(ID, "Payment_CustomerName")
    limit = frequency.hot_limit(source, 1)
    hot = stats.stats(source).where(F.col(frequency.ROWS) >= limit).collect()
    assert sorted(r[frequency.ROWS] for r in hot) == [100, 100]
    split = family_features(skewed, "name", options=Options(hot_rows=1)).orderBy(ID).collect()
    assert plain == split


@pytest.mark.parametrize("family", ["ip", "channel", "partner", "mcc"])
def test_split_does_not_change_results(skewed, family):
    plain = family_features(skewed, family, options=Options(hot_rows=0)).orderBy(ID).collect()
    split = family_features(skewed, family, options=Options(hot_rows=30)).orderBy(ID).collect()
    assert plain == split


def test_hot_rows_meet_their_statistics_by_broadcast_only(stored):
    plan = plan_text(family_features(stored, "name", options=Options(hot_rows=100)), "formatted")
    assert "BroadcastHashJoin" in plan
    assert "LeftAnti" not in plan


def test_no_python_and_no_cross_join(stored, spark, sf_dir):
    ruca = derived.ruca(spark, sf_dir)
    for name in FAMILIES:
        plan = plan_text(family_features(stored, name, ruca, Options(hot_rows=100)), "extended")
        assert "Python" not in plan and "Cartesian" not in plan and "Window" not in plan


def test_scan_reads_only_the_columns_of_the_family(stored):
    plan = plan_text(family_features(stored, "email"), "formatted")
    schemas = set(re.findall(r"ReadSchema: struct<(.*?)>", plan))
    columns = {c.split(":")[0] for s in schemas for c in s.split(",") if c}
    assert columns <= {ID, "EmailAddress"}


def test_filters_reach_the_scan(stored, spark, sf_dir):
    plan = plan_text(family_features(stored, "geo", derived.ruca(spark, sf_dir)), "formatted")
    assert "IsNotNull(Zip)" in plan


def test_top_k_does_not_sort_everything(stored):
    plan = plan_text(top_k(family_features(stored, "pricing"), "pricing_model_other", 10))
    assert "TakeOrderedAndProject" in plan


def _wide_shuffles(plan: str) -> list[str]:
    """Partitioning of every shuffle that carries full payment rows (a fee column is in it)."""
    nodes = [n for n in re.split(r"\n\n+", plan) if n.split("\n")[0].endswith(" Exchange")]
    return [
        re.search(r"Arguments: (\w+\(\S+?)#", n).group(1) for n in nodes if "LIC_INT_FIXED" in n
    ]


@pytest.fixture
def no_broadcast(spark):
    """Plans as for large inputs: nothing is small enough to broadcast by itself."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


# The lookup is below the broadcast threshold in real sessions; here it costs the shuffle by ZIP.
BY_ID, BY_ZIP = f"hashpartitioning({ID}", "hashpartitioning(__geo_zip_5digit"


def test_large_input_shuffles_the_full_rows_once(stored, spark, sf_dir, no_broadcast):
    large = assemble_features(stored, derived.ruca(spark, sf_dir), Options(hot_rows=100))
    assert sorted(_wide_shuffles(plan_text(large, "formatted"))) == sorted([BY_ID, BY_ZIP])


def test_bucketed_payments_are_not_shuffled(stored, spark, sf_dir, no_broadcast):
    write_payments_bucketed(stored, "payments_bucketed", 8)
    payments = spark.table("payments_bucketed")
    large = assemble_features(payments, derived.ruca(spark, sf_dir), Options(hot_rows=100))
    assert _wide_shuffles(plan_text(large, "formatted")) == [BY_ZIP]


def test_repeated_ids_are_refused_whatever_is_selected(spark, sf_dir):
    payments, ruca = derived.payments(spark, sf_dir, duplicates=True), derived.ruca(spark, sf_dir)
    features = assemble_features(payments, ruca, Options(hot_rows=100))
    for columns in ([ID], ["pricing_model_other"], ["email_frequency"], ["distinct_partners_per_id"]):
        with pytest.raises(Exception, match="is not unique"):
            features.select(columns).collect()


def test_null_ids_are_kept_in_both_modes(make_payments, make_ruca):
    payments = make_payments(
        [{"Partner": "Oracle", "Zip": "90210", "Pricing Model": "Flat"} for _ in range(21)]
    ).withColumn(ID, F.when(~F.col(ID).isin("P0", "P4", "P8", "P12", "P16", "P20"), F.col(ID)))
    ruca = make_ruca([("90210", 1, 1.0, "CA")])
    single = assemble_features(payments, ruca, Options(hot_rows=5))
    joined = assemble_features(payments, ruca, mode="join")
    assert single.count() == joined.count() == 21
    assert Counter(map(tuple, single.collect())) == Counter(map(tuple, joined.collect()))
    partner = family_features(payments, "partner")
    assert partner.where(F.col(ID).isNull() & (F.col("distinct_partners_per_id") == 0)).count() == 6


def _fact_scans(plan: str) -> int:
    """Scans of payments in a formatted plan, reused exchanges aside."""
    return len(re.findall(r"ReadSchema: struct<(?!kind|key|__rows|n_nationkey)\w", plan))


def test_facts_are_scanned_four_times(stored, spark, sf_dir, no_broadcast):
    """Twice for the stored counts of all keys, twice for the rows, with hot keys and without."""
    counts = key_counts(stored)
    counts.collect()
    ran = plan_text(counts, "formatted").split("== Initial Plan ==")[0]
    # The pairs of channel and customer are scanned and shuffled once, for channels and for groups.
    tree = ran.split("\n\n")[0]
    assert len(re.findall(r"Scan parquet\s+\(", tree)) == 2 and "ReusedExchange" in tree
    for hot_rows in (100, None):
        large = assemble_features(stored, derived.ruca(spark, sf_dir), Options(hot_rows=hot_rows))
        assert _fact_scans(plan_text(large, "formatted")) == 2


def test_methods_too_large_for_the_jvm_are_not_run(spark):
    """The JVM interprets methods of more than 8,000 bytes, so stages with such a one are run in parts."""
    assert int(tune(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000


def test_keys_are_computed_before_they_are_taken_apart(stored, spark, sf_dir):
    """What stands in a generator is interpreted where it is not part of a generated stage."""
    for frame in (key_counts(stored), assemble_features(stored, derived.ruca(spark, sf_dir))):
        generators = re.findall(r"Generate (inline\(.{0,12})", plan_text(frame, "simple"))
        assert generators and all(re.match(r"inline\(__keys#", g) for g in generators), generators


def test_keys_are_computed_once(stored, spark, sf_dir):
    """Spark filters what it takes apart by the size of the array, for which it computes all keys once more."""
    for frame in (key_counts(stored), assemble_features(stored, derived.ruca(spark, sf_dir))):
        assert "(size(" not in plan_text(frame, "extended").split("== Optimized Logical Plan ==")[1]


def _nodes_with(node, column: str) -> list[str]:
    """Names of the nodes of a logical plan that hand on the column by itself."""
    output, children = node.output(), node.children()
    here = [node.nodeName()] if column in {output.apply(i).name() for i in range(output.size())} else []
    return here + [n for i in range(children.size()) for n in _nodes_with(children.apply(i), column)]


@pytest.mark.parametrize("hot_rows", [None, 100])
def test_full_rows_pass_few_steps(stored, spark, sf_dir, hot_rows):
    """They meet the narrow records and the lookup; after that, finished columns are in one piece."""
    features = assemble_features(stored, derived.ruca(spark, sf_dir), Options(hot_rows=hot_rows))
    names = _nodes_with(features._jdf.queryExecution().optimizedPlan(), "LIC_INT_FIXED")
    assert names.count("Join") == 2 and names.count("Project") <= 4, names


def _join_widths(node) -> list[int]:
    """Numbers of columns that the joins above the master family hand on."""
    output, children = node.output(), node.children()
    names = {output.apply(i).name() for i in range(output.size())}
    here = [output.size()] if node.nodeName() == "Join" and "__master" in names else []
    return here + [n for i in range(children.size()) for n in _join_widths(children.apply(i))]


@pytest.mark.parametrize("expose", [True, False])
def test_families_pass_the_joins_in_one_piece(stored, spark, sf_dir, expose):
    """The id and a column for each family, in eleven joins; the table is the one of 281 columns or one less."""
    joined = assemble_features(stored, derived.ruca(spark, sf_dir), Options(expose_card_number=expose), "join")
    widths = _join_widths(joined._jdf.queryExecution().optimizedPlan())
    assert len(widths) == 11 and max(widths) <= 1 + 12 + 1, widths
    single = assemble_features(stored, derived.ruca(spark, sf_dir), Options(expose_card_number=expose))
    assert joined.dtypes == single.dtypes and len(joined.columns) == 280 + expose


def test_payments_without_id_pass_the_joins_in_one_piece(spark, sf_dir):
    """They meet no family: the pieces of all but the first are NULL, and so is what is taken from them."""
    payments = derived.payments(tune(spark), sf_dir, null_ids=True)
    joined = assemble_features(payments, derived.ruca(spark, sf_dir), mode="join")
    widths = _join_widths(joined._jdf.queryExecution().optimizedPlan())
    assert len(widths) == 11 and max(widths) <= 1 + 12 + 1, widths
    without = joined.where(F.col(ID).isNull()).select("TDNum", "email_frequency", "partner_category", "area_type")
    assert sorted(map(tuple, without.collect())) == [(f"T{k}", None, None, None) for k in (4, 5, 6)]


def test_families_of_repeated_ids_are_combined(make_payments, make_ruca):
    """Both rows of an id meet both rows in each of the other families; geo has the one with a ZIP."""
    payments = make_payments([
        {ID: "A", "Partner": "Oracle", "RemoteIP": "10.0.0.1", "Zip": "90210"},
        {ID: "A", "Partner": "SAP Cloud", "RemoteIP": "10.0.0.2"},
        {ID: "B", "Partner": "Oracle", "RemoteIP": "10.0.0.1"},
        {ID: "none", "Partner": "Oracle"},
    ]).withColumn(ID, F.when(F.col(ID) != "none", F.col(ID)))
    joined = assemble_features(payments, make_ruca([("90210", 1, 1.0, "CA")]), mode="join")
    pick = joined.select(ID, "Partner", "ip_frequency", "distinct_partners_per_id", "RUCA1")
    found = Counter(map(tuple, pick.collect()))
    # Master, name, e-mail, address, card, channel, MCC, provider and price double what is told apart here.
    assert found == {
        **{("A", p, n, 2, 1): 2 ** 9 for p in ("Oracle", "SAP Cloud") for n in (2, 1)},
        ("B", "Oracle", 2, 1, None): 1, (None, None, None, None, None): 1,
    }


def test_bracket_classes_are_spelled_out(spark):
    """Members one by one match what ranges do, for each character and in both match modes."""
    patterns = [p for k, p in vars(V).items() if k.endswith("_PATTERN")]
    chars = spark.range(0x300).selectExpr("decode(encode(chr(id), 'UTF-8'), 'UTF-8') AS c").unionByName(
        spark.createDataFrame([("\u2028",), ("\u00df",), ("\u0130",), ("\U0001f600",), ("a\tb",), ("a\x0bb",), ("",)], "c string")
    )
    for pattern in patterns:
        ours = spelled_out(pattern)
        assert not re.search(r"\[[^\]]*(A-Z|a-z|0-9|\\s)", ours), ours
        for form in ("{}", r"\A(?:{})\z"):
            a, b = (F.col("c").rlike(form.format(p)) for p in (pattern, ours))
            assert chars.where(a != b).isEmpty(), pattern
    searched = Matcher().regex(F.col("c"), V.NAME_SPECIAL_PATTERN)
    assert "A-Z" not in plan_text(chars.select(searched), "simple")


def test_narrow_records(stored):
    """One record per payment, and one for each key that is not hot."""
    counts = key_counts(stored)
    assert counts.groupBy("kind").agg(F.sum(frequency.ROWS).alias("n")).where(
        F.col("n") != stored.count()).isEmpty()
    assert counts.groupBy("key").count().where("count > 1").isEmpty()


@pytest.fixture
def keyed(make_payments):
    """Keys on one row, on two and on many, blank and missing ones among them."""
    return make_payments(
        [
            {"Payment_CustomerName": f"Name {min(i, 40)}", "EmailAddress": f"u{i // 2}@mail.com",
             "RemoteIP": None if i % 5 == 0 else f"10.0.{i % 7}.{i}", "CustomerID": str(i % 3),
             "PaymentSourceDesc": "IVR" if i else "Rare", "Partner": f"P{i}" if i < 3 else None}
            for i in range(60)
        ] + [{}]
    )


@pytest.mark.parametrize("words", [1, 64, 1 << 20])
@pytest.mark.parametrize("hot_rows", [None, 10])
def test_keys_of_one_row_need_no_look_up(keyed, make_ruca, monkeypatch, words, hot_rows):
    """Equal to the families joined by id, whether the bitmap tells keys apart, is full or is left out."""
    from payscope.plans import assemble

    ruca = make_ruca([("90210", 1, 1.0, "CA")])
    monkeypatch.setattr(assemble, "MARK_WORDS", words)
    single = assemble_features(keyed, ruca, Options(hot_rows=hot_rows))
    joined = assemble_features(keyed, ruca, mode="join")
    assert Counter(map(tuple, single.collect())) == Counter(map(tuple, joined.collect()))


def test_keys_on_a_thousand_rows_send_no_records(make_payments, make_ruca, monkeypatch):
    """Without a threshold of the caller's, and with the same features as the families joined by id."""
    from payscope.plans import assemble

    names = ["Often"] * 1_200 + ["Twice"] * 2 + ["Once"]
    payments = make_payments([{"Payment_CustomerName": name, "RemoteIP": f"10.0.0.{i}"} for i, name in enumerate(names)])
    ruca = make_ruca([("90210", 1, 1.0, "CA")])
    sent, only_repeated = [], assemble._only_repeated

    def seen(records, marks, kinds):
        sent.append(records.where("kind = 'name'").count())
        return only_repeated(records, marks, kinds)

    monkeypatch.setattr(assemble, "_only_repeated", seen)
    single = assemble_features(payments, ruca)
    assert sent == [3]
    columns = [c for c in single.columns if "name" in c.lower()]
    joined = assemble_features(payments, ruca, mode="join")
    rows = [Counter(map(tuple, f.select(columns).collect())) for f in (single, joined)]
    assert rows[0] == rows[1]


def test_records_of_keys_of_one_row_are_not_sent(spark):
    from payscope.plans.assemble import _only_repeated, repeated_marks

    counts = spark.range(20_000).selectExpr("concat('k', id) AS key", "id % 10 = 0 AS twice")
    marks = repeated_marks(counts.where("twice"))
    records = counts.selectExpr("key", "twice", "'a' AS kind").unionByName(
        counts.selectExpr("key", "twice", "'other' AS kind"))
    sent = {(r.kind, r.twice): r["count"] for r in
            _only_repeated(records, marks, ["a"]).groupBy("kind", "twice").count().collect()}
    assert sent[("other", True)] == sent[("a", True)] == 2_000
    assert sent[("other", False)] == 18_000 and sent.get(("a", False), 0) < 10
    assert marks.count() <= 2_000


def test_a_second_action_makes_no_records(spark, make_payments, make_ruca):
    """It reads each payment once, for its full row; what the keys have met is there from the first one."""
    rows = make_payments([{"RemoteIP": f"10.0.0.{i % 4}", "Partner": "Oracle"} for i in range(60)])
    seen = spark.sparkContext.accumulator(0)

    def counted(key):
        seen.add(1)
        return key

    payments = rows.withColumn(ID, F.udf(counted, "string")(ID))
    features = assemble_features(payments, make_ruca([("90210", 1, 1.0, "CA")]))
    assert features.limit(1).count() == 1
    before = seen.value
    assert Counter(r.ip_frequency for r in features.select(ID, "ip_frequency").collect()) == {15: 60}
    assert seen.value - before == 60


def test_tables_are_read_with_checked_types(stored, spark):
    stored.limit(3).write.mode("overwrite").saveAsTable("typed_payments")
    assert read_payments(spark, table="typed_payments").count() == 3
    stored.limit(3).withColumn("PaymentAmount", F.lit(1.5)).drop("Zip").write.mode(
        "overwrite").saveAsTable("mistyped_payments")
    with pytest.raises(ValueError, match="Zip is missing.*PaymentAmount is double"):
        read_payments(spark, table="mistyped_payments")
    with pytest.raises(ValueError):
        read_payments(spark)


def test_samples_of_any_fraction(spark):
    from payscope.operators.profile import sample_rows

    ids = spark.range(300_000).select(F.col("id").cast("string").alias(ID))
    assert 0 < sample_rows(ids, 0.00004).count() < 40
    some = ids.limit(20).unionByName(spark.createDataFrame([(None,)], f"{ID} string"))
    assert sample_rows(some, 1.0).count() == 21


def test_combined_table(stored, spark, sf_dir):
    options = Options(expose_card_number=True)
    features = assemble_features(stored, derived.ruca(spark, sf_dir), options)
    assert len(features.columns) == 281
    assert len({c.lower() for c in features.columns}) == 281
    path = scratch_path(spark, "combined")
    write_features(features, path=path)
    back = spark.read.parquet(path)
    assert back.columns == features.columns
    assert back.count() == stored.count()
    networks = ["Is_Visa", "Is_Mastercard", "IS_AMEX", "IS_DISCOVER", "IS_JCB", "IS_DinersClub",
                "IS_Unknown"]
    prices = [c for c in back.columns if c.startswith("pricing_model_")]
    types = [c for c in back.columns if c.startswith("IS_Type_")] + ["IS_Unknown_Invalid"]
    flags = [c for c, t in back.dtypes if t == "int" and c.lower().startswith(("is_", "has_"))]
    row = back.agg(
        F.min(sum(F.col(c) for c in networks)), F.max(sum(F.col(c) for c in networks)),
        F.min(sum(F.col(c) for c in prices)), F.max(sum(F.col(c) for c in prices)),
        F.max(sum(F.col(c) for c in types)),
        *[F.count(F.when(~F.col(c).isin(0, 1), 1)) for c in flags],
    ).first()
    assert list(row)[:5] == [1, 1, 1, 1, 1]
    assert not any(list(row)[5:])


def test_table_sink_replaces(stored, spark):
    features = family_features(stored, "pricing")
    write_features(features, table="pricing_features_table")
    write_features(features.limit(3), table="pricing_features_table")
    assert spark.table("pricing_features_table").count() == 3
    with pytest.raises(ValueError):
        write_features(features)


@pytest.mark.parametrize("kind", ["table", "path"])
def test_failed_write_keeps_the_old_rows(stored, spark, kind):
    features = family_features(stored, "pricing")
    at = {kind: "kept_features" if kind == "table" else scratch_path(spark, "kept")}
    read = spark.table if kind == "table" else spark.read.parquet
    name = at[kind]
    write_features(features.limit(5), **at)
    # The task fails on one of the last rows, after files were begun.
    broken = features.withColumn(
        "pricing_model_other",
        F.when(F.rand(1) < 0.01, F.raise_error(F.lit("no more"))).otherwise(1),
    )
    with pytest.raises(Exception, match="no more"):
        write_features(broken, **at)
    assert read(name).count() == 5
    # The new rows may be made of those they replace.
    write_features(read(name).limit(4), **at)
    assert read(name).count() == 4
    # A run that died between the renames: the old rows are put back, then replaced.
    if kind == "table":
        spark.sql(f"ALTER TABLE {name} RENAME TO {name}__previous")
    else:
        import os

        os.rename(name.removeprefix("file:"), name.removeprefix("file:") + "__previous")
    with pytest.raises(Exception, match="no more"):
        write_features(broken, **at)
    assert read(name).count() == 4
    write_features(features.limit(2), **at)
    assert read(name).count() == 2
    if kind == "table":
        left = [t.name for t in spark.catalog.listTables() if t.name.startswith(name)]
        assert left == [name]


@pytest.mark.parametrize("at", ["kept", "`kept`", "default.kept", "default.`kept`"])
def test_staged_names(spark, at):
    rows = spark.range(3).withColumn(ID, F.col("id").cast("string")).drop("id")
    for n in (3, 2):
        write_features(rows.limit(n), table=at, buckets=2)
    assert spark.table(at).count() == 2
    spark.sql(f"DROP TABLE {at}")


def test_more_rows_never_lower_a_frequency(skewed, make_payments):
    before = {r[ID]: r.ip_frequency for r in family_features(skewed, "ip").collect()}
    more = skewed.unionByName(make_payments([{ID: "extra", "RemoteIP": "10.0.0.1"}]))
    after = {r[ID]: r.ip_frequency for r in family_features(more, "ip").collect()}
    assert all(after[i] >= n for i, n in before.items())


def test_unknown_arguments_are_refused(stored):
    with pytest.raises(ValueError):
        family_features(stored, "nope")
    with pytest.raises(ValueError):
        family_features(stored, "geo")
    with pytest.raises(ValueError):
        assemble_features(stored, stored, mode="both")
    with pytest.raises(ValueError):
        Options(match="glob")
    assert isinstance(FAMILIES["name"], Family)
