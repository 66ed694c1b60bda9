from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docpipe import config as C
from docpipe.operators import chunking as K
from docpipe.operators import sections as S

WORDS = lambda n, w="word": " ".join([w] * n)


def chunks(*texts, path="a"):
    return K.chunk_sections([(path, [path], t) for t in texts])


def test_fitting_sections_and_overlap():
    first = " ".join(f"This is sentence number {i} of many." for i in range(40))
    got = chunks(first, WORDS(300, "next"))
    assert len(got) == 2 and got[0].content == first
    tail, _, rest = got[1].content.partition("\n\n")
    assert first.endswith(tail) and tail and rest == WORDS(300, "next")


def test_small_chunk_joins_previous_then_next():
    assert [c.content for c in chunks(WORDS(300), WORDS(20, "x"))] == [WORDS(300) + "\n\n" + WORDS(20, "x")]
    assert [c.content for c in chunks(WORDS(20, "x"), WORDS(300))] == [WORDS(20, "x") + "\n\n" + WORDS(300)]
    assert len(chunks(WORDS(690), WORDS(79, "x"))) == 1


def test_cross_section_limit_is_lower():
    rows = [("a", ["a"], WORDS(690)), ("b", ["b"], WORDS(20, "x"))]
    assert len(K.chunk_sections(rows)) == 2


def test_large_section_splits_at_paragraphs():
    text = "\n\n".join(WORDS(240, f"p{i}") for i in range(8))
    got = chunks(text)
    assert len(got) > 1 and all(c.tokens <= C.HARD_MAX_CHUNK for c in got)
    assert "\n\n".join(c.content for c in got) == text


def test_code_stays_whole():
    code = "```js\n" + "\n".join(f"call({i});" for i in range(120)) + "\n```"
    got = chunks(WORDS(400) + "\n\n" + "This explains the code below.\n\n" + code)
    assert any(code in c.content for c in got)


def test_code_dominated_is_kept():
    code = "```\n" + WORDS(1200, "x") + "\n```"
    assert [c.content for c in chunks(code)] == [code]


def test_one_long_paragraph_by_sentences_then_words():
    got = chunks(" ".join("Alpha beta gamma delta." for _ in range(500)))
    assert all(c.tokens <= C.SOFT_MAX_CHUNK for c in got) and len(got) > 2
    got = chunks(WORDS(2000))
    assert sum(K.regex_tokens(c.content) for c in got) == 2000 and all(c.tokens <= C.SOFT_MAX_CHUNK for c in got)


def test_sentences_fall_back():
    assert K.sentences("a: b; c") == ["a:", "b;", "c"]
    assert K.sentences("a, b") == ["a,", "b"]
    assert K.sentences("a | b") == ["a", "b"]
    assert K.sentences("One. ```x. y``` Two.") == ["One.", "```x. y``` Two."]


def test_blank_and_empty():
    assert K.chunk_sections([]) == []
    assert [c.content for c in chunks("")] == [""]
    assert chunks("\n\n" * 3)[0].content == ""


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(1, 400), min_size=1, max_size=6), min_size=1, max_size=5))
def test_no_word_is_lost(sizes):
    texts = ["\n\n".join(WORDS(n, f"s{i}p{j}") for j, n in enumerate(row)) for i, row in enumerate(sizes)]
    got = " ".join(c.content for c in chunks(*texts))
    for i, row in enumerate(sizes):
        for j, n in enumerate(row):
            assert got.count(f"s{i}p{j}") >= n


@pytest.mark.parametrize("bad", [{"min_chunk_size": 0}, {"max_chunk_size": 400}, {"target_chunk_size": 900}, {"min_overlap_size": -1}, {"max_overlap_size": 10}, {"max_overlap_size": 600}])
def test_config(bad):
    with pytest.raises(ValueError):
        C.ChunkingConfig(**bad)


def test_sections_tree():
    body = "Intro text\n\n# One\npara\nmore\n\n## Two\n```py\nx = 1\n```\n\n#### Deep\n- a\n- b\n\n## Three\n```py\nx = 1\n```\nSetext\n------\n\n***\ntail"
    got = S.sections(body)
    assert [s["section_path"] for s in got] == [["One"], ["One", "Two"], ["One", "Two", "Deep"], ["One", "Three"], ["One", "Setext"]]
    assert [s["content"] for s in got] == ["Intro text\n\npara\nmore", "```py\nx = 1\n```", "a\nb", "", "---\n\ntail"]
    assert S.sections("no heading") == []


def test_front_matter():
    assert S.split_front_matter("---\na: 1\n---\nbody") == ({"a": 1}, "body")
    assert S.split_front_matter("body")[0] == {}


def test_tables(spark):
    df = spark.createDataFrame([("p", "# A\n" + WORDS(100)), ("q", None), ("r", "plain")], "doc_path string, body string")
    rows = S.sections_tree(df).withColumn("section", S.flat_path(F.col("section_path")))
    got = K.chunk_documents(rows).collect()
    assert [(r.doc_path, r.section, r.token_count) for r in got] == [("p", "A", 100)]


def test_regex_tokens_counts_as_the_pattern_does():
    import random

    from docpipe.operators.chunking import _TOKEN, regex_tokens

    signs = [chr(c) for c in range(128)] + list("aab1234 .\n") * 10 + list("é—ß٣٤५六\u2003\u0085ʰ") * 3
    draw = random.Random(7)
    for _ in range(20_000):
        text = "".join(draw.choices(signs, k=draw.randint(0, 25)))
        assert regex_tokens(text) == len(_TOKEN.findall(text)), text
    assert regex_tokens("") == 0


def test_spread_deals_rows_out_by_number(spark, tmp_path):
    """A small file of many rows is cut by bytes into few splits; rows decide."""
    from docpipe.shipping import ROWS, spread

    spark.range(6 * ROWS).selectExpr("id % 3 AS x").coalesce(1).write.parquet(str(tmp_path / "t"))
    scan = spark.read.parquet(str(tmp_path / "t"))
    assert scan.rdd.getNumPartitions() < 6 <= spread(scan).rdd.getNumPartitions()
    assert spread(scan.limit(10)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_documents_go_to_python_in_batches(spark):
    """No call of Python for each document; sections come in order of seq, those without content go."""
    rows = spark.createDataFrame(
        [(str(d), s, f"h{s}", ["h"], None if s == 1 else f"w{s} " * 100) for d in range(3) for s in (2, 0, 1)],
        "doc_path string, seq int, section string, section_path array<string>, content string",
    )
    found = K.chunk_documents(rows)
    assert "FlatMapGroups" not in found._jdf.queryExecution().toString()
    got = {(r.doc_path, r.chunk_seq, r.section, tuple(r.section_path), r.content[:2], r.token_count) for r in found.collect()}
    assert got == {(str(d), i, f"h{s}", ("h",), f"w{s}", 200) for d in range(3) for i, s in enumerate((0, 2))}
