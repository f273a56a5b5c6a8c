from lexcurate.cli import main

GOOD = "The plaintiff and the defendant cite 42 U.S.C. " + "x" * 1000


def test_pipeline(spark, tmp_path, capsys):
    p = lambda n: str(tmp_path / n)
    docs = [(str(k), f"{k} {GOOD}", f"http://s{k % 3}.x/a") for k in range(30)]
    spark.createDataFrame(docs, "id string, text string, url string").write.parquet(p("in"))
    run = lambda *a: main(list(a), spark)
    common = ["--input", p("in"), "--output", p("ann"), "--registry", p("reg"), "--batch-size", "20"]
    assert run("annotate", *common, "--dry-run") == 0
    assert run("annotate", *common) == 0 and run("resume", *common) == 0
    assert spark.read.parquet(p("ann")).groupBy("batch").count().orderBy("batch").collect()[1]["count"] == 10
    assert run("merge", "--input", p("ann"), "--output", p("merged")) == 0
    assert run("stats", "--input", p("merged"), "--inventory", "--json", p("stats")) == 0
    assert spark.read.json(p("stats")).first()["samples"] == 30
    assert run("validate", "--input", p("merged")) == 0
    assert run("samples", "--input", p("merged"), "--count", "2") == 0
    assert run("stage1", "--input", p("in"), "--output", p("kept"), "--checkpoint", p("check")) == 0
    assert spark.read.parquet(p("kept")).count() == 30
    assert run("consolidate", "--output", p("cons"), "--whole", p("whole"), p("merged")) == 0
    assert spark.read.parquet(p("whole")).count() == 30 and spark.read.parquet(p("whole")).inputFiles()[1:] == []
    assert run("funnel", "--input", p("in"), "--json", p("funnel")) == 0 and spark.read.json(p("funnel")).count() == 1
    assert run("annotate", "--input", p("in"), "--output", p("more"), "--batch-size", "5") == 0 and spark.read.parquet(p("more")).count() == 5
    scored = spark.createDataFrame([(d[0], d[1], d[2], k % 6 * 1.0) for k, d in enumerate(docs)], "id string, text string, url string, score double")
    scored.write.parquet(p("scored"))
    assert run("tiers", "--input", p("scored"), "--output", p("tiers")) == 0
    assert run("publish", "--input", p("tiers"), "--output", p("manifest.json")) == 0
    assert run("analyse", "--input", p("scored")) == 0
    assert run("train", "--input", p("scored"), "--model", p("model"), "--iterations", "2") == 0
    assert run("evaluate", "--input", p("scored"), "--model", p("model")) == 0
    assert run("stage2", "--input", p("in"), "--output", p("s2"), "--model", p("model"), "--threshold", "0") == 0
    assert spark.read.parquet(p("s2") + "/*").count() == 30
    assert run("stage2", "--input", p("in"), "--output", p("s2"), "--model", p("model")) == 0 and "0 files scored" in capsys.readouterr().out
    assert run("annotate", "--input", p("in"), "--output", p("more"), "--target", "5") == 0
    assert run("ablate", "--input", p("scored")) == 0
    assert run("audit", "--input", p("in"), "--output", p("audit"), "--model", p("model"), "--skip", "5", "--count", "3") == 0
    assert "regularisation" in capsys.readouterr().out
