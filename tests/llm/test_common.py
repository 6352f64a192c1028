from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from telvault.llm import common


def test_gapless_position(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 0, id % 7) as g", "id % 11 as o")
    got = common.gapless_position(df, ["g"], ["o", "id"], "at").collect()
    by = {}
    for r in got:
        by.setdefault(r["g"], []).append((r["o"], r["id"], r["at"]))
    assert len(got) == 5000 and all([x[2] for x in sorted(v)] == list(range(len(v))) for v in by.values())
    assert common.gapless_position(df.where("false"), ["g"], ["o", "id"], "at").count() == 0


def parts(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in list(up)}


def labels(spark, edges):
    got = common.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert len(got) == len({r["node"] for r in got})
    return {r["node"]: r["label"] for r in got}


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(edges=st.lists(st.tuples(st.integers(-20, 20), st.integers(-20, 20)).filter(lambda e: e[0] != e[1]), min_size=1, max_size=25))
def test_components_of_any_graph(spark, edges):
    assert labels(spark, edges) == parts(edges)


def test_components_of_a_path_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(40)] + [(1000, 1001 + k) for k in range(300)] + [(7, 7)]
    assert labels(spark, edges) == parts([e for e in edges if e[0] != e[1]])
    assert labels(spark, []) == {}


def test_crc32_is_that_of_the_decimal_text(spark):
    import zlib
    row = spark.range(12345, 12346).select(common.crc32_text(common.F.col("id")).alias("c")).first()
    assert row["c"] == zlib.crc32(b"12345")


def test_shared_dir_reads_the_setting(spark):
    assert common.shared_dir(spark).endswith(spark.sparkContext.applicationId)
    assert Counter([common.fresh("a", spark.range(1).withColumnRenamed("id", "A"))]) == Counter(["a_"])


def test_cluster_without_a_shared_folder_is_refused():
    class Session:
        def __init__(self, master, **conf):
            self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})
            self.conf = {"spark.sql.warehouse.dir": "/wh/"} | conf

    assert common.shared_dir(Session("local[*]")) == common.shared_dir(Session("local")) == "/wh/_shared/llm/app"
    assert common.shared_dir(Session("yarn", **{"spark.checkpoint.dir": "hdfs://x/shared/"})) == "hdfs://x/shared/llm/app"
    for master in ("yarn", "spark://h:7077", "local-cluster[3,2,1024]", "k8s://https://h"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            common.shared_dir(Session(master))
