"""Filter audit, fill-in-the-middle and page text: odd values, ties, repeated rows, no rows, and plain versions."""

import collections
import hashlib
import itertools
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from moniker.llm import audit, middle, pages
from tests.llm.test_operators import ODD, rows_of


def in_duck(tmp_path, sql, **tables):
    duck = duckdb.connect()
    for name, frame in tables.items():
        frame.write.parquet(str(tmp_path / name))
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}/*.parquet'")
    return duck.sql(sql)


# --- 11: fill in the middle -------------------------------------------------------------


def middle_rows():
    draw = random.Random(11)
    alphabet = ["a", "é", "𝔘", " ", "\n", "\t", "\x0b", " ", "<", "P", ">", "word"]
    rows = [(100 + i, "".join(draw.choice(alphabet) for _ in range(draw.randrange(60)))) for i in range(200)]
    rows += [(500 + i, f"x{s}y z w") for i, s in enumerate(["<P>", "<S>", "<M>", "<P", "S>"] * 4)]
    return rows + [(700 + i, " ") for i in range(9)] + [(720 + i, "long words " * 20_000 + "\n") for i in range(4)] + ODD + [(-5, "one two three")] * 2


def test_middle_equals_its_sql(documents, tmp_path):
    docs = documents(middle_rows())
    got = middle.fill_in_middle(docs, digests=True)
    want = in_duck(tmp_path, middle.MIDDLE_SQL, documents=docs)
    assert want.columns == ["doc_id", *got.columns[1:]]
    assert rows_of(got) == sorted(want.fetchall(), key=repr)
    assert middle.fill_in_middle(docs.where("false")).count() == 0


def test_outputs_come_back_exactly(documents):
    rows = middle_rows()
    texts = collections.defaultdict(list)
    for key, text in rows:
        texts[key].append(text or "")
    forms = collections.Counter()
    for r in middle.fill_in_middle(documents(rows)).collect():
        forms[r["form"]] += 1
        assert middle.restore(r["output"].encode(), r["form"]).decode() in texts[r["id"]]
        assert (r["prefix_chars"] is None) == (r["form"] == "plain")
    assert min(forms.values()) > 10 and len(forms) == 3


@pytest.mark.parametrize("form", ["psm", "spm"])
def test_segments_stand_where_the_form_says(form):
    out = bytes(middle.arrange(b"aabbbcc", 2, 5, form))
    assert out == {"psm": b"<P>aa<S>cc<M>bbb", "spm": b"<S>cc<P>aa<M>bbb"}[form]
    for a, b in itertools.combinations_with_replacement(range(8), 2):
        assert middle.restore(middle.arrange(b"aabbbcc", a, b, form), form) == b"aabbbcc"


def test_rotation():
    for begin, mid, end in itertools.combinations_with_replacement(range(9), 3):
        view = np.arange(9)
        middle.rotate(view, begin, mid, end)
        plain = list(range(9))
        assert view.tolist() == plain[:begin] + plain[mid:end] + plain[begin:mid] + plain[end:]


# --- 13: filter audit -------------------------------------------------------------------


def audit_rows():
    draw = random.Random(13)
    rows = []
    for i in range(150):
        words = [draw.choice("abcdefgh") + (str(j) if i % 3 else "") for j in range(draw.choice([5, 99, 100, 130]))]
        text = " ".join(words) + draw.choice(["", " #", " |", " A" * 200])
        rows.append((i, text, draw.choice(["en", "de", None, ""]), "a"))
    rows += [(200 + i, rows[i % 7][1], "en", "a") for i in range(60)] + [rows[3], rows[3], (None, rows[4][1], "fr", "a")]
    return rows + [(*r, "en", "a") for r in ODD]


def plain_audit(rows, labels):
    """Every order applied to every document."""
    least = {}
    for key, text, *_ in rows:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    docs = []
    for key, text, lang, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words)}
        fails |= {"C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text))}
        fails["E"] = key is not None and key > least[text]
        docs.append((lang or "", fails, *labels.get(key, (0, 0))))
    out, shapley = {}, collections.Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part, fails, good, toxic in docs:
            gone = False
            for step, f in enumerate(order, 1):
                row = out.setdefault((part, order, step), [0] * 6)
                if gone:
                    row[2] += fails[f]
                elif fails[f]:
                    gone = True
                    row[1] += 1
                    row[4] += good
                    row[5] += toxic
                    shapley[part, f] += 1
                else:
                    row[0] += 1
                row[3] += fails[f] and sum(fails.values()) == 1
    return sorted(((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()), key=repr)


def test_audit(spark, documents, tmp_path):
    rows = audit_rows()
    marks = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 210, 3)] + [(3, 0, 1), (None, 1, 1), (6, None, None), (10**6, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").withColumns({c: F.lit("x") for c in ("id", "n", "part")})
    told = {}
    for key, *own in marks:
        if key is None:
            continue
        told[key] = tuple(max(int(x == 1), y) for x, y in zip(own, told.get(key, (0, 0)), strict=True))
    docs = documents(rows)
    got = rows_of(audit.audit_filters(docs, labels))
    assert got == plain_audit(rows, told)
    want = in_duck(tmp_path, audit.AUDIT_SQL, documents=docs, labels=labels)
    assert got == sorted(want.fetchall(), key=repr)
    assert audit.audit_filters(docs.where("false"), labels).count() == 0
    assert audit.audit_filters(docs, labels.where("false")).count() == len(got)


def test_intervals_cover_every_order_once():
    for mask in range(32):
        found = sorted(i for _, a, b in audit.intervals(mask) for i in range(a, b))
        assert found == (list(range(120)) if mask else [])


# --- 12: page text ----------------------------------------------------------------------


def page_table(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({c: F.lit("x") for c in ("host", "node", "text", "kind", "n")})


def texts_of(spark, rows):
    return {r["page_id"]: r["text"] for r in pages.main_texts(page_table(spark, rows), ["page_id", "url"]).collect()}


CASES = [
    ("<p>a  b\n c&amp;&#233;&nosuch; &am<br>d", "a b c&é&nosuch; &am d"),
    ("<article><header><h1>T</h1></header><p>one<p>two <b>three<i></p><aside>x</aside></article><p>out</p>", "T\none\ntwo three"),
    ("<main><div class='content has-sidebar'><p>in</p></div><form>f<p>g</p></form></main><footer>no", "in"),
    ("<nav>n</nav><header>h</header><div id='cookieNotice'>c</div><div class='ad'>a</div><section id=comments><p>c</p></section><p>text", "text"),
    ("<ul><li>a<li>b<ul><li>c</ul>d</ul><table><tr><td>1<td>2<tr><td>3</table>", "a\nb\nc\nd\n1\n2\n3"),
    ("x<script>if (a < b) '</p>'</script>y<!-- <p>z</p> -->w<style>p{}</style>", "xyw"),
    ("Hello <span class=ad>x <span>u</span> y</span> world<hr>z", "Hello world\nz"),
    ("<div title='a > b hidden'>shown</div><div hidden>no</div><div aria-hidden=true>no</div>", "shown"),
    ("a < b <c", "a < b <c"),
    ("<div>" * 3000 + "deep" + "</p>" * 3000, "deep"),
    (None, ""),
    ("", ""),
]


def test_pages_alone(spark):
    rows = [(i, u, h) for i, (h, _) in enumerate(CASES) for u in ("http://h%d.org/x" % i,)]
    told = texts_of(spark, [*rows, (99, None, "<p>q"), (99, "nowhere", "<p>q"), (None, "", "<p>r")])
    assert [told[i] for i in range(len(CASES))] == [t for _, t in CASES]
    assert told[99] == "q" and told[None] == "r"
    assert pages.main_texts(page_table(spark, rows).where("false"), ["page_id", "url"]).count() == 0


def site(host, n, first, seed):
    """Pages whose parts have names that say nothing; only the tree can tell what is repeated."""
    draw = random.Random(seed)
    sell = [f"Buy our {x} today and save" for x in ("tea", "hats", "pens")]
    for i in range(n):
        own = [f"{' '.join(draw.choice('abcdefghij') * 3 for _ in range(12))} {first + i}x{k}" for k in range(draw.randrange(1, 5))]
        own = ["".join(chr(97 + draw.randrange(26)) for _ in range(30)) + " " + t for t in own]
        html = f"<body><div class=xa><p>{draw.choice(sell)}</p><ul><li>Start</li><li>Contact</li></ul></div>"
        html += f"<div class=xb><h1>{own[0]}</h1>{''.join(f'<p>{t}</p>' for t in own)}</div><div class=xc>All rights with us {i}</div>"
        yield (first + i, f"https://{host}/p{i}?q=1", html), "\n".join([own[0], *own])


def test_style_tree_tells_what_a_site_repeats(spark, monkeypatch):
    made = [*site("one.org", 60, 0, 1), *site("two.org", 40, 100, 2), *site("small.org", 2, 200, 3)]
    rows, want = [r for r, _ in made], {r[0]: t for r, t in made}
    assert texts_of(spark, rows) == want
    monkeypatch.setattr(pages, "BROADCAST", 0)
    assert texts_of(spark, rows) == want


def test_copies_of_one_page_keep_their_text(spark):
    (row, want), *_ = site("copies.org", 1, 0, 4)
    told = texts_of(spark, [(i, row[1], f"<article>{row[2]}</article>") for i in range(30)])
    assert set(told) == set(range(30)) and all(want in t for t in told.values())
