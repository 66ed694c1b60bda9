from __future__ import annotations

import json

from pyspark.sql import functions as F

from docpipe import cli
from docpipe.operators import validate
from docpipe.plans import fixtures


def test_whole_run(spark, tmp_path, capsys):
    pages, specs, out = tmp_path / "pages", tmp_path / "specs", str(tmp_path / "out")
    (pages / "payments").mkdir(parents=True)
    (specs / "payments").mkdir(parents=True)
    (pages / "payments/a.mdx").write_text("---\npage_title: A\n---\n# A\n" + "word " * 100 + "\n## B\n" + " ".join(f"text{i}" for i in range(2000)))
    (specs / "payments/small.json").write_text(json.dumps(fixtures.openapi(2, 5)))

    def run(*args):
        code = cli.main([*args, "--out", out], spark)
        return code, json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    code, stats = run("ingest", "--pages", str(pages), "--specs", str(specs), "--repo", str(tmp_path))
    assert code == 0 and stats["files"] == 2
    again = run("ingest", "--pages", str(pages), "--specs", str(specs), "--repo", str(tmp_path), "--export", str(tmp_path / "all.json"))[1]
    assert (again["processed"], again["skipped"], again["chunks"]) == (0, 2, stats["chunks"])
    assert len(json.loads((tmp_path / "all.json").read_text())["chunks"]) == stats["chunks"]
    assert run("normalize-pages", "--pages", str(pages))[1] == {"pages": 1, "passed": True, "errors": []}
    assert (tmp_path / "out/normalized/payments/a.md").exists()
    (specs / "payments/gone.json").write_text(json.dumps(fixtures.openapi(1, 5)))
    (specs / "payments/bad.json").write_text("{")
    done = run("normalize-specs", "--specs", str(specs))[1]
    assert done["files"] == 2 and [e["path"] for e in done["errors"]] == ["payments/bad.json"]
    (specs / "payments/gone.json").unlink()
    (specs / "payments/bad.json").unlink()
    assert run("normalize-specs", "--specs", str(specs))[1] == {"files": 1, "errors": []}
    files = [p for p in (tmp_path / "out/specifications").rglob("*.md")]
    assert [p.name for p in files] == ["small.md"] and files[0].read_text().startswith("# ")
    assert run("check-token-limits")[0] == 0
    assert run("smoke-test", "--least", "2")[0] == 0
    assert run("smoke-test")[0] == 1
    assert run("sync")[0] == 1  # too few chunks
    code, dry = run("sync", "--least", "1", "--dry-run")
    assert code == 0 and dry["written"] == 0 and dry["plan"]["insert"] > 0
    code, first = run("sync", "--least", "1")
    assert code == 0 and first["written"] == first["plan"]["insert"]
    code, second = run("sync", "--least", "1")
    assert code == 0 and second["written"] == 0 and second["refreshed"] == first["written"]
    code, report = run("verify")
    assert code == 0, report
    assert run("upload-content")[1] == {"uploaded": 0}


def test_checks(spark):
    df = spark.createDataFrame([("Hi <div class='x'> <Foo a> <id> ```<Bar b>``` https://x.y/z Word",)], "t string")
    row = df.select(validate.markup_left(F.col("t")).alias("m"), validate.meaningful_words(F.col("t")).alias("w")).first()
    assert row.m == ["<Foo a>", "<div class='x'>"]
    assert row.w == ["div", "class", "foo", "word"]
    pages = spark.createDataFrame([("a", "# A\n# B\n# C", "# A"), ("b", "x" * 200, "y")], "doc_path string, text string, body string")
    assert [(r.lost, r.emptied) for r in validate.heading_loss(pages).orderBy("doc_path").collect()] == [(True, False), (False, True)]
