from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from docpipe.functions import markup as M


@pytest.mark.parametrize(
    ("page", "inside", "outside"),
    [
        ("---\ntitle: $1 X\n---\n# H", ["Metadata\ntitle: $1 X"], ["---"]),
        ('<Callout type="tip"> Read <b>this</b> {x} </Callout>', ["**Note:** Read this"], ["<"]),
        ('<img src="a.png" alt="x"/>', ["![](a.png)"], ["<img"]),
        ('<a href="/x">docs</a>', ["docs (/x)"], ["<a"]),
        ("<NextPage info={a} />text", ["text"], ["NextPage"]),
        ('<MainImage src="a"></MainImage>text', ["text"], ["MainImage"]),
        ('<CodeBlockWithCopy language="json">{`\n{"a": 1}\n`}</CodeBlockWithCopy>', ['```json\n{"a": 1}\n```'], ["CodeBlock"]),
        ("import A from 'b';\nexport default X;\n\n# Title", ["# Title"], ["import", "export"]),
        ("<Card><Text>in</Text></Card>", ["in"], ["<"]),
        ("<Foo><Bar>deep</Bar></Foo>", ["deep"], ["<"]),
        ("[t](u) ![i](v)\n```\n[a](b)\n```", ["t (u)", "![i](v)", "[a](b)"], []),
        ("<Tabs tabs={[{key: 'a', label: 'One', content: (<X>{`long enough code`}</X>)}]}></Tabs>", ["#### One", "long enough code"], ["Tabs"]),
        (":::note\nx\n:::", ["x"], [":::"]),
        ("<ul><li>a</li><li>b</li></ul>", ["- a", "- b"], ["<"]),
    ],
)
def test_normalize(page, inside, outside):
    got = M.normalize_text(page)
    assert all(x in got for x in inside), got
    assert not any(x in got for x in outside), got


@pytest.mark.parametrize("page", ["", "   \n "])
def test_blank(page):
    assert M.normalize_text(page) == ""


def test_columns_agree_with_python(spark):
    pages = ["<p>a</p><PRE>b</PRE><hr/>x<br>y", '<a href="/x">t</a> <strong>b</strong><em>i</em><code>c</code>', "<Image a/>", "import x from 'y'\nz", "[a](b) ```[a](b)``` c", ""]
    df = spark.createDataFrame(pd.DataFrame({"p": pages}))
    c = F.col("p")
    got = df.select(M.html_to_markdown(c), M.strip_presentational(c), M.strip_imports(c), M.convert_links(c)).collect()
    for page, row in zip(pages, got):
        want = [M._rules(page, M.html_rules()), M._rules(page, M.presentational_rules()), M._rules(page, M.IMPORTS), M._links(page)]
        assert list(row) == want


def test_null_stays(spark):
    assert spark.createDataFrame([(None,)], "p string").select(M.normalize_page("p")).first()[0] is None
