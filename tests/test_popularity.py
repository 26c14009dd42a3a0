import pytest
from pyspark.sql import functions as F

from conftest import SF01
from robustagg.operators import popularity as pop
from robustagg.plans.popularity_report import popularity_report
from robustagg.sources import transactions as tx


@pytest.fixture(scope="module")
def txn(spark):
    return tx.transactions_from_tables(spark, SF01)


def _pairs_list(rows):
    return [(r["product_id"], r["popularity"]) for r in rows]


def test_fixture_counts(spark, txn):
    lines = tx.transaction_lines_from_tables(spark, SF01)
    assert lines.count() == 60000
    assert pop.keep_transactions(txn).count() == 39954
    assert pop.keep_transactions(txn, "nation_3").count() == 1838
    assert pop.product_customer_pairs(txn).count() == 39697
    assert pop.product_customer_pairs(txn, "NATION_3").count() == 1827


def test_fixture_top_and_first(spark, txn):
    top = popularity_report(txn, 5).orderBy("rank").collect()
    assert _pairs_list(top) == [("1936", 35), ("722", 34), ("817", 34), ("954", 34), ("1110", 33)]
    assert [r["rank"] for r in top] == [1, 2, 3, 4, 5]
    top_c = popularity_report(txn, 5, "Nation_3").orderBy("rank").collect()
    assert _pairs_list(top_c) == [("4", 6), ("1236", 5), ("145", 5), ("1531", 5), ("1936", 5)]
    first = popularity_report(txn, 0).limit(4).collect()
    assert _pairs_list(first) == [("0", 24), ("1", 19), ("10", 28), ("100", 16)]
    first_c = popularity_report(txn, 0, "nation_3").limit(4).collect()
    assert _pairs_list(first_c) == [("0", 2), ("1", 1), ("100", 1), ("1004", 3)]


def test_plain_equals_salted(txn):
    pairs = pop.product_customer_pairs(txn)
    a = pop.product_popularity(pairs)
    for k in (1, 3, 16):
        b = pop.product_popularity_salted(pairs, k)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_text_and_typed_paths_agree(spark, txn):
    lines = tx.transaction_lines_from_tables(spark, SF01)
    a = pop.product_customer_pairs(tx.split_transactions(lines), "nation_3")
    b = pop.product_customer_pairs(txn, "NATION_3")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_by_product_is_string_order(txn):
    ids = [r["product_id"] for r in popularity_report(txn, 0).collect()]
    assert ids == sorted(ids)
    assert ids.index("10") < ids.index("2")


GOOD = [
    "1,P1,a,3,d,1.0,100,Italy",
    "2,P1,a,5,d,1.0,100,italy",      # repeated pair (other case)
    "3,P1,a,1,d,1.0,101,France",
    "4,P2,a,2,d,1.0,100,ITALY",
    "5,P2,a,0,d,1.0,102,Italy",      # quantity 0: dropped
    "6,P3,a,-4,d,1.0,103,Italy",     # negative: dropped
    "7,P3,a,-1,d,1.0,,Italy",        # blank customer on a rejected row: harmless
    "8,P4,a,9,d,1.0,104,Spain",
]


def _write(tmp_path, name, lines):
    p = tmp_path / name
    p.write_text("\n".join(lines) + "\n")
    return str(p)


def _run(spark, path, country):
    df = tx.split_transactions(tx.read_transaction_lines(spark, path))
    return sorted((r["product_id"], r["customer_id"])
                  for r in pop.product_customer_pairs(df, country).collect())


def test_hand_fixture(spark, tmp_path):
    path = _write(tmp_path, "good.txt", GOOD)
    assert _run(spark, path, "all") == [("P1", 100), ("P1", 101), ("P2", 100), ("P4", 104)]
    assert _run(spark, path, "ALL") == _run(spark, path, None)
    assert _run(spark, path, "iTaLy") == [("P1", 100), ("P2", 100)]
    df = tx.split_transactions(tx.read_transaction_lines(spark, path))
    pops = {r["product_id"]: r["popularity"]
            for r in pop.product_popularity(pop.product_customer_pairs(df)).collect()}
    assert pops == {"P1": 2, "P2": 1, "P4": 1}
    # tied popularities are ordered by product id
    top = popularity_report(df, 3).orderBy("rank").collect()
    assert [r["product_id"] for r in top] == ["P1", "P2", "P4"]


BAD = [
    ("6,C,x,1,d,1.0,,France", "fail", "ok"),
    ("6,C,x,1", "fail", "fail"),
    ("6,C,x,0", "ok", "ok"),
    ("6,C", "fail", "fail"),
    ("6,C,x,1,d,1.0,12,", "ok", "fail"),
    ("6,C,x,1,d,1.0,,", "fail", "fail"),
    ("", "fail", "fail"),
    ("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country",
     "fail", "fail"),
]


@pytest.mark.parametrize("line,all_result,italy_result", BAD)
def test_bad_lines(spark, tmp_path, line, all_result, italy_result):
    path = _write(tmp_path, "bad.txt", GOOD + [line])
    for country, expected in (("all", all_result), ("Italy", italy_result)):
        if expected == "fail":
            with pytest.raises(Exception):
                _run(spark, path, country)
        else:
            got = _run(spark, path, country)
            if line == "6,C,x,1,d,1.0,12," and country == "all":
                assert ("C", 12) in got


def test_arguments_rejected(txn):
    pairs = pop.product_customer_pairs(txn)
    with pytest.raises(ValueError):
        pop.popularity_top_h(pop.product_popularity(pairs), 0)
    with pytest.raises(ValueError):
        pop.product_popularity_salted(pairs, 0)
    with pytest.raises(ValueError):
        popularity_report(txn, -1)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(txn):
    top = popularity_report(txn, 5)
    plan = _plan(top)
    assert "TakeOrderedAndProject" in plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    # partial aggregation before the shuffle for both the distinct and the count
    pp = _plan(pop.product_popularity(pop.product_customer_pairs(txn)))
    assert pp.count("HashAggregate") >= 4


from hypothesis import HealthCheck, given, settings, strategies as st

_COUNTRIES = ["Italy", "italy", "ITALY", "France", "Spain"]
_ROW = st.tuples(st.sampled_from(["P1", "P2", "P10", "P3"]), st.integers(-3, 5),
                 st.integers(100, 104), st.sampled_from(_COUNTRIES))


@settings(max_examples=15, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(_ROW, min_size=1, max_size=40),
       country=st.sampled_from([None, "all", "iTaLy", "france"]),
       salts=st.integers(1, 5), h=st.integers(1, 4))
def test_random_logs_against_python(spark, rows, country, salts, h):
    lines = [f"{i},{p},x,{q},d,1.0,{c},{n}" for i, (p, q, c, n) in enumerate(rows)]
    df = tx.split_transactions(spark.createDataFrame([(v,) for v in lines], "value string"))
    keep = [(p, c) for p, q, c, n in rows
            if q > 0 and (country in (None, "all") or n.lower() == country.lower())]
    want = {}
    for p, c in set(keep):
        want[p] = want.get(p, 0) + 1
    pairs = pop.product_customer_pairs(df, country)
    plain = {r["product_id"]: r["popularity"] for r in pop.product_popularity(pairs).collect()}
    salted = {r["product_id"]: r["popularity"]
              for r in pop.product_popularity_salted(pairs, salts).collect()}
    assert plain == want and salted == want
    top = [(r["product_id"], r["popularity"])
           for r in popularity_report(df, h, country).orderBy("rank").collect()]
    assert top == sorted(want.items(), key=lambda kv: (-kv[1], kv[0]))[:h]
