"""Lines of similarities: one HSP is told by plain columns, several by functions of arrays, and both are read alike."""

from genoweave.plans import catalogue
from genoweave.sources import formats


def test_one_hsp_takes_no_function_of_arrays(spark, sf_dir):
    plan = catalogue.queries()["src_bpo"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    told = plan[plan.index("CASE WHEN") :].split(" THEN ")
    assert "Contains(" in told[0] and told[1].startswith("array(struct(n") and "transform(" not in told[1].split(" ELSE ")[0]


def test_hsps_and_evalues_of_odd_lines(spark):
    one, other = (1, 1, 5, 2, 6), (2, 3, 4, 5, 6)
    lists = {
        "1:1-5:2-6": [one], "1:1-5:2-6.": [one], "1:1-5:2-6.2:3-4:5-6": [one, other], "1:1-5:2-6..2:3-4:5-6.": [one, other], "1:1-5:2-6.\n": [one], "": [], ".": [],
        "1": [(1, None, None, None, None)], "1:-2-3:4": [(1, None, 2, 4, None)], "a:1-5-7:2": [(None, 1, 5, 2, None)], " ": [(None,) * 5],
    }
    evalues = {"e-10": (1e-10, 1.0, -10), "2e-7": (2e-7, 2.0, -7), "0": (0.0, 0.0, 0), "e-": (None, 1.0, 0), "": (None, None, 0), "3e5": (3e5, 3.0, 5), "x": (None, None, 0)}
    rows = [(f"7;q;3;s;4;{e};50;{h}", h, e) for h in lists for e in evalues]
    for r in formats.bpo(spark.createDataFrame([(v, i) for i, (v, _, _) in enumerate(rows)], "value string, lot int")).collect():
        _, h, e = rows[r["lot"]]
        assert [tuple(x) for x in r["hsps"]] == lists[h] and (r["evalue"], r["mantissa"], r["exponent"]) == evalues[e]
        assert (r["sim_id"], r["query"], r["qlen"], r["subject"], r["slen"], r["pident"]) == (7, "q", 3, "s", 4, 50)
    bare = formats.bpo(spark.createDataFrame([(None,), ("1;q",)], "value string")).collect()
    assert [(r["sim_id"], r["query"], r["hsps"], r["exponent"]) for r in bare] == [(None, None, None, 0), (1, "q", None, 0)]
