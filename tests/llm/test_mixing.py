import pytest
from pyspark.sql import functions as F

from pagewright.llm import mixing
from pagewright.llm.tokens import encoder

DOCS = [(i, f"slovo {i} a další text", " Aktuality" if i % 2 else "aktuality") for i in range(60)] + [(100 + i, "krátký text", "podnety") for i in range(3)] + [(200, None, "podnety"), (201, "jiný text", None), (202, "", "x")]
TARGETS = [("Aktuality", 0.6, 2), ("podnety", 0.3, 4), ("nic", 0.1, 3)]


def tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string, source string").selectExpr("*", "'z' AS name", "1 AS n_tokens")
    return docs, spark.createDataFrame(TARGETS, "source string, target_share double, max_repeat int")


def test_out_of_reach_against_brute_force(spark):
    docs, targets = tables(spark)
    n = {d[0]: len(encoder().encode_ordinary(d[1] or "")) for d in DOCS}
    total = sum(n.values())
    have = {s: sum(n[d[0]] for d in DOCS if d[2] and d[2].strip().lower() == s.lower()) for s, _, _ in TARGETS}
    wanted = {s for s, share, cap in TARGETS if have[s] * cap < share * total}
    assert {r.source for r in mixing.out_of_reach(docs, targets).collect()} == wanted
    assert wanted == {"podnety", "nic"}
    assert mixing.out_of_reach(docs.limit(0), targets).count() == 0
    assert mixing.out_of_reach(docs, targets.limit(0)).count() == 0


@pytest.mark.parametrize("bucket_docs", [7, 1000])
def test_curriculum_gives_what_is_demanded(spark, bucket_docs):
    docs, targets = tables(spark)
    knots = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(w).alias("w")) for t, w in ((0.0, 0.0), (0.5, 1.0), (1.0, 1.0))])
    placed = mixing.curriculum(docs, targets, targets.where("source = 'Aktuality'").select("source", knots.alias("knots")), bucket_docs=bucket_docs)
    rows = placed.collect()
    d = {r.source: r for r in mixing.demands(mixing.counted(docs), targets).collect()}
    for source in ("Aktuality", "podnety"):
        own = [r for r in rows if r.source == source]
        given = sum(r.n_tokens for r in own)
        assert d[source].given <= given < d[source].given + max(r.n_tokens for r in own)
        assert len({(r.doc_id, r.copy) for r in own}) == len(own)
        assert all(0 <= r.position <= 1 and r.copy < d[source].max_repeat for r in own)
    assert {r.source for r in rows} == {"Aktuality", "podnety"}
    early = sum(r.n_tokens for r in rows if r.source == "Aktuality" and r.position < 0.5) / d["Aktuality"].given
    assert early == pytest.approx(1 / 3, abs=0.05)
    half = sum(r.n_tokens for r in rows if r.source == "podnety" and r.position < 0.5) / d["podnety"].given
    assert half == pytest.approx(0.5, abs=0.05)


def test_shares_sum_to_one(spark):
    docs, targets = tables(spark)
    got = {r.source: r for r in mixing.shares(docs, targets).collect()}
    assert sum(r.actual_share for r in got.values()) == pytest.approx(1)
    assert got["nic"].actual_share == 0 and got["podnety"].repeats == 4
