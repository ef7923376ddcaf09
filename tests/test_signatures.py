from itertools import combinations

import pytest
from pyspark.sql import functions as F

from palisade.config import SignatureSettings
from palisade.operators.signatures import SignatureMiner, SignatureModel, candidate_rules, mine_signatures, rule_text

SETTINGS = SignatureSettings(min_support=0.005, min_confidence=0.9)


@pytest.fixture(scope="module")
def model(traffic):
    return SignatureMiner(SETTINGS).fit(traffic.filter("row_id < 1500"))


@pytest.fixture(scope="module")
def unseen(traffic, model):
    return model.transform(traffic.filter("row_id >= 1500")).cache()


def greedy(rows, settings, categorical, flags):
    """The rules by the plain definition: rank all candidates, keep those no kept rule contains."""
    n_total, candidates = len(rows), []

    def add(columns, keep):
        groups = {}
        for r in rows:
            key = tuple(r[c] for c in columns)
            if None not in key and keep(key):
                groups.setdefault(key, []).append(r["label"])
        for key in sorted(groups):
            ys = groups[key]
            support, confidence = len(ys) / n_total, sum(ys) / len(ys)
            if support >= settings.min_support and confidence >= settings.min_confidence:
                candidates.append((dict(zip(columns, map(str, key))), support, confidence, len(ys)))

    for c in categorical:
        add([c], lambda key: True)
    for c in flags:
        add([c], lambda key: key == (1,))
    if settings.max_combo_size >= 2:
        for pair in combinations(categorical, 2):
            add(list(pair), lambda key: True)
    kept = []
    for rule in sorted(candidates, key=lambda r: (-r[2], -r[1])):
        if not any(k[0].items() <= rule[0].items() for k in kept):
            kept.append(rule)
    return kept[: settings.max_rules]


@pytest.mark.parametrize("settings", [
    SETTINGS,
    SignatureSettings(min_support=0.0, min_confidence=0.0, max_rules=1000),
    SignatureSettings(min_support=0.001, min_confidence=0.2, max_rules=7),
    SignatureSettings(min_support=0.001, min_confidence=0.2, max_combo_size=1),
    SignatureSettings(min_support=0.001, min_confidence=0.25, max_combo_size=5),
])
def test_rules_equal_the_definition(traffic, settings):
    with_gaps = traffic.withColumn("flag", F.when(F.col("row_id") % 50 != 0, F.col("flag")))
    got = [
        (r["conditions"], r["support"], r["confidence"], r["match_count"])
        for r in mine_signatures(with_gaps, "label", settings).orderBy("rank").collect()
    ]
    assert got == greedy(with_gaps.collect(), settings, ["protocol_type", "service", "flag"], ["land"])


def test_pruning_rare_values_keeps_the_rules(traffic):
    many = traffic.withColumn(
        "service", F.when(F.col("row_id") % 3 == 0, F.concat(F.lit("s"), F.col("row_id"))).otherwise(F.col("service"))
    )
    for support in (0.01, 0.0):
        plain = SignatureSettings(min_support=support, min_confidence=0.1, max_rules=5000)
        pruned = SignatureSettings(min_support=support, min_confidence=0.1, max_rules=5000, prune_rare=True)
        assert (
            mine_signatures(many, "label", pruned).orderBy("rank").collect()
            == mine_signatures(many, "label", plain).orderBy("rank").collect()
        )
    small = candidate_rules(many, "label", SignatureSettings(min_support=0.01, prune_rare=True))
    assert small.count() < 100 < candidate_rules(many, "label", SignatureSettings()).count()


def test_planted_rules_are_found(spark, model):
    rules = {r["rule"] for r in model.rules(spark).collect()}
    assert {"flag=S0", "land=1"} <= rules


def test_hits_are_precise_but_not_complete(unseen):
    hit, right, attacks = unseen.agg(F.sum("sig"), F.sum(F.col("sig") * F.col("label")), F.sum("label")).first()
    assert right / hit >= 0.95 and 0 < right / attacks < 1


def test_higher_confidence_gives_fewer_candidates(traffic):
    counts = [
        mine_signatures(traffic, "label", SignatureSettings(min_confidence=c, max_combo_size=1, max_rules=1000)).count()
        for c in (0.2, 0.5, 0.9)
    ]
    assert counts == sorted(counts, reverse=True)


def test_one_scan_mines_everything(traffic, spark, tmp_path):
    traffic.write.parquet(str(tmp_path / "t"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = spark.read.parquet(str(tmp_path / "t"))
    rules = mine_signatures(df.mapInArrow(count, df.schema), "label", SETTINGS).collect()
    assert rules and seen.value == traffic.count()  # every row passed by once


def test_unfitted_model(traffic):
    with pytest.raises(ValueError):
        SignatureModel().transform(traffic)


def test_no_attacks_no_rules(spark):
    df = spark.createDataFrame([(i, "SF", 0) for i in range(100)], "row_id int, flag string, label int")
    model = SignatureMiner(SETTINGS).fit(df)
    assert model.rule_count == 0
    assert model.rules(spark).count() == 0 and "rule" in model.rules(spark).columns
    assert model.transform(df).agg(F.sum("sig")).first()[0] == 0


def test_rule_on_an_absent_column_or_missing_value_never_matches(spark, model):
    df = spark.createDataFrame([(None, 0), ("S0", 0), ("SF", 1)], "flag string, land int")
    assert [r["sig"] for r in model.transform(df).collect()] == [0, 1, 1]
    assert [r["sig"] for r in model.transform(df.drop("flag")).collect()] == [0, 0, 1]


def test_flags_match_on_the_number_one(spark, model):
    df = spark.createDataFrame([("SF", 1.0), ("SF", 0.0), ("SF", None)], "flag string, land double")
    assert [r["sig"] for r in model.transform(df).collect()] == [1, 0, 0]


def test_no_usable_column(spark):
    df = spark.createDataFrame([(1.0, 1)], "x double, label int")
    assert mine_signatures(df, "label", SETTINGS).count() == 0


def test_rule_text(traffic):
    text = rule_text(mine_signatures(traffic, "label", SETTINGS)).orderBy("rank").first()["text"]
    assert text.startswith("IF ") and " THEN Attack (support=0." in text


def test_saved_model(spark, model, traffic, tmp_path):
    model.write().overwrite().save(str(tmp_path / "m"))
    again = SignatureModel.load(str(tmp_path / "m"))
    assert again.learned == model.learned
