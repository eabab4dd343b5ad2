"""Very long texts, and what the trained models add, against plain recomputation."""

from __future__ import annotations

import random
import re
import time

import pytest

from entiva.llm import elias_fano, html_text, secrets

LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def word(draw, size):
    return "".join(draw.choice(LETTERS) for _ in range(size))


@pytest.fixture(scope="module")
def model(spark):
    draw = random.Random(3)
    parts = "ka le mi no ru sta ver con der ung ent ation KA LE MI NO RU VER CON".split()
    rows = []
    for i in range(400):
        names = ["_".join("".join(draw.choices(parts, k=4)) for _ in range(2)) for _ in range(5)]
        rows.append((i, f"token={word(draw, 30)} {' '.join(names)}"))
    return secrets.fit(spark.createDataFrame(rows, "doc_id long, text string"))


def plain_added(model, text, base):
    """Runs that are likelier as random strings and overlap no base span."""
    found = []
    for match in re.finditer(secrets.CANDIDATE, text):
        before, total = 0, 0.0
        for character in match[0]:
            total += float(f"{model.ratios[before * secrets.SIZE + ord(character)]:.4f}")
            before = ord(character)
        if not re.search("[A-Za-z]", match[0]) or total < 8.0:
            continue
        if not any(b[0] < match.end() and match.start() < b[2] for b in base):
            found.append((match.start(), 3, match.end()))
    return found


def test_added_spans_equal_recomputed_ratios(spark, model):
    draw = random.Random(4)
    pieces = [
        lambda: word(draw, draw.randrange(10, 40)),
        lambda: "password = " + word(draw, draw.randrange(3, 30)),
        lambda: "AKIA" + word(draw, 20).upper(),
        lambda: "%032x" % draw.getrandbits(128),
        lambda: "some_ordinary_function_value",
        lambda: "é🎉",
        lambda: "token=" + "%030x" % draw.getrandbits(110),
    ]
    rows = [
        (i, " ".join(draw.choice(pieces)() for _ in range(draw.choice((1, 5, 40, 900)))))
        for i in range(60)
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    texts = dict(rows)
    added = 0
    for row in secrets.secrets(frame, model).collect():
        base = [tuple(s) for s in row.base]
        assert base == sorted(base)
        assert [tuple(s) for s in row.added] == plain_added(model, texts[row.doc_id], base)
        added += len(row.added)
    assert added > 500


def test_secrets_in_very_long_texts(spark, model):
    draw = random.Random(5)
    run = word(draw, 1_000_000)
    many = " ".join(f"password: {word(draw, 20)} {word(draw, 30)}" for _ in range(100_000))
    for text, base, least in ((run, 0, 1), (many, 100_000, 50_000)):
        frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.time()
        row = secrets.secrets(frame, model).first()
        assert time.time() - start < 30
        assert (len(row.base), len(row.added) >= least) == (base, True), len(row.added)
        assert all(one.end <= two.start for one, two in zip(row.added, row.added[1:]))


def test_secrets_of_odd_rows_with_a_model(spark, model):
    rows = [(1, None), (1, None), (2, ""), (None, "password=abcdef"), (4, " " * 5000), (5, "x" * 50000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'x' as base", "'y' as runs", "'z' as spans"
    )
    found = secrets.secrets(frame, model).collect()
    assert sorted((r.doc_id or 0, len(r.base)) for r in found) == [
        (0, 1), (1, 0), (1, 0), (2, 0), (4, 0), (5, 0)
    ]
    assert secrets.secrets(frame.limit(0), model).count() == 0


def test_file_names_with_one_slash(tmp_path):
    for prefix in ("", "file:", "file://"):
        assert elias_fano.on_disk(f"{prefix}{tmp_path}/a") == f"{tmp_path}/a"
    assert elias_fano.on_disk("s3://b/a") == "s3://b/a"


SENTENCE = "This is a sentence, with commas, long enough to count as real text of the page."


@pytest.mark.parametrize(
    "piece",
    ["<a href='x ", "<a '>' ", "<textarea>", "<!x ", "<b>", "<b><p>", "<i></b>", "<a \"'>", "< <"],
)
def test_broken_pages_of_a_megabyte(piece):
    start = time.time()
    html_text.main_text(f"<p>{SENTENCE}</p>" + piece * (1_000_000 // len(piece)))
    assert time.time() - start < 10


def test_a_stray_quote_spoils_its_tag_only():
    page = f"<p>{SENTENCE}</p><p class='a title=b>{SENTENCE}</p><nav>menu</nav><p>{SENTENCE}</p>"
    assert html_text.main_text(page) == " ".join([SENTENCE] * 3)


def test_forms_that_wrap_the_page_and_lists_of_links_in_the_article():
    article = f"<article><h1>Head</h1><p>{SENTENCE}</p><ul><li><a href=a>One item</a><li>" \
        f"<a href=b>Two items</a></ul></article>"
    expected = f"Head {SENTENCE} One item Two items"
    menu = "<div id=menu><a href=/>Home</a></div><ul><li><a href=a>a</a></ul>"
    assert html_text.main_text(f"<body>{article}</body>") == expected
    assert html_text.main_text(f"<body><form>{menu}{article}</form></body>") == expected
    body = f"<form>{menu}<div id=c><h1>Head</h1><p>{SENTENCE}</p><p>{SENTENCE}</p></div></form>"
    assert html_text.main_text(body) == f"Head {SENTENCE} {SENTENCE}"
    box = "<form><p>Your name, please</p><input></form>"
    assert html_text.main_text(f"<body>{article}{box}</body>") == expected


def test_pages_on_repeated_rows(spark):
    rows = [(1, "u", f"<p>{SENTENCE}</p>")] * 2 + [(None, None, None)] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = sorted((r.page_id or 0, r.text, r.n_chars) for r in html_text.extract(pages).collect())
    assert found == [(0, "", 0)] * 2 + [(1, SENTENCE, len(SENTENCE))] * 2
