"""Problems on texts: held-out accuracy, fixed cases, and nulls, empties, repeats and clashes."""

import random
import re
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartolex.llm import budget, layout, residue, stuffing, tongues

CLASH = ["id", "label", "t", "l", "h", "page", "col", "status", "x", "k", "lang", "tokens", "words"]
SF01 = Path("/root/testdata/sf0.01")


def clash(df):
    return df.withColumns({c: F.lit(1) for c in CLASH if c not in df.columns})


@pytest.fixture(scope="module")
def pages(spark):
    if not SF01.exists():
        pytest.skip("no test data here")
    return spark.read.parquet(f"{SF01}/website.parquet")


@pytest.fixture(scope="module")
def releases(spark):
    if not SF01.exists():
        pytest.skip("no test data here")
    return spark.read.parquet(f"{SF01}/release_rows.parquet")


# --- problem 7 ---------------------------------------------------------------------------------------------------

PAGE = """Skip to main content
Home | News | Prices | Contact
* Events
* Gallery

* Jobs
Welcome to Oldham
The path from A to B crosses the old moor and passes 12 kilns.
Loop 3: A to B, 7 km, shaded
Adults 8 crowns, children 2 crowns, groups on request
Our kiln sells oat cookies, and guests accept them all.
The warden, who lives… [more]
You are here: Home > Places > Oldham
© 2020 www.oldham.example - All rights reserved"""


def weak(text):
    return np.array(layout.weak_furniture(text), bool)


def test_weak_labels_by_shape_and_phrase():
    assert np.flatnonzero(weak(PAGE)).tolist() == [0, 1, 2, 3, 5, 11, 12, 13]


@pytest.fixture(scope="module")
def website(spark):
    """(host, language, text) of a larger table's pages."""
    path = "/root/testdata/sf0.1/website.parquet"
    if not Path(path).exists():
        pytest.skip("no test data here")
    rows = spark.read.parquet(path).where("website_text_status = 'success' and website_text is not null").select("website", "website_language", "website_text").collect()
    return [(re.sub(r"^https?://|^www[.]|/.*$", "", (r[0] or "").lower()), (r[1] or "")[:2], r[2]) for r in rows]


@pytest.fixture(scope="module")
def lines(website):
    return layout.Lines().fit([t for _, _, t in website[:3000]])


def told(lines, texts):
    """(recall, precision) of lines against their weak labels, which the judged pages' phrases give and no fit has seen."""
    got = np.concatenate(lines.furniture(texts))
    want = np.concatenate([weak(t) for t in texts])
    return (got & want).sum() / want.sum(), (got & want).sum() / got.sum()


def test_lines_of_unseen_hosts(website):
    """No phrase is asked for when a line is judged: hosts of one half are fitted, those of the other half judged."""
    half = lambda h: sum(map(ord, h)) % 2
    model = layout.Lines().fit([t for h, _, t in website if half(h)])
    recall, precision = told(model, [t for h, _, t in website if not half(h)])
    assert recall > 0.99 and precision > 0.99


@pytest.mark.parametrize("lang", ["nl", "it"])
def test_lines_of_an_unseen_language(website, lang):
    model = layout.Lines().fit([t for _, x, t in website if x != lang][:2500])
    recall, precision = told(model, [t for _, x, t in website if x == lang])
    assert recall > 0.95 and precision > 0.97


def test_lines_of_texts_of_its_own(lines):
    finnish = "Etusivu | Uutiset | Yhteystiedot | Kartta\n\nVanha mylly seisoo joen rannalla ja sen vieressä kasvaa kaksi suurta koivua. Se on auki joka päivä.\n\n* Etusivu\n* Uutiset\n* Kartta\n* Galleria"
    assert np.flatnonzero(lines.furniture([finnish])[0]).tolist() == [0, 4, 5, 6, 7]
    prose = "The home page of the mill at www.mill.com is open daily, and the warden who lives there answers all letters. Guests may climb the ladder to the hide."
    assert not lines.furniture([prose])[0].any()
    got = set(np.flatnonzero(lines.furniture([PAGE])[0]).tolist())
    assert got >= {1, 2, 3, 5, 13} and not got & {6, 7, 8, 9, 10}


@pytest.mark.parametrize("text", ["", "\n\n", "a", "x" * 300_000, "* a\n* b", "|" * 50, "\r\n \r\n"])
def test_any_text_has_a_verdict_per_line(lines, text):
    assert len(weak(text)) == len(lines.furniture([text])[0]) == len(layout.Lines().furniture([text, "b"])[0]) == len(text.split("\n"))


def test_html_is_rendered_with_implied_tags_and_hidden_parts():
    html = "<title>t</title><p>One<p>Two <b>bold</b><ul><li>a<li>b</ul><div style='display: none'>no</div><table><tr><td>Mon<td>9-17<tr><td>Tuesday<td>10</table>End<script>1</script><p hidden>h"
    assert layout.render(html).split("\n") == ["One", "", "Two bold", "", "* a", "* b", "", "Mon      9-17", "Tuesday  10", "", "End"]
    assert layout.render("<div>" * 5000 + "deep") == "deep"


def test_lines_of_pages(spark, lines):
    rows = [(1, PAGE, "success", None, None), (2, PAGE, "timeout", "* Home\n* Map\n* News", "success"), (3, None, "success", "", "success"), (None, PAGE, "success", None, None), (1, "* Home\n* Map\n* News\n", "success", None, "success")]
    df = clash(spark.createDataFrame(rows, "page_id long, website_text string, website_text_status string, contact_website_text string, contact_website_text_status string"))
    got = sorted(tuple(r) for r in layout.furniture_lines(df, lines).collect())
    marks = np.flatnonzero(lines.furniture([PAGE])[0]).tolist()
    assert got == sorted([(1, "website_text", k) for k in (*marks, 0, 1, 2)] + [(2, "contact_website_text", k) for k in (0, 1, 2)])
    assert layout.bodies(df, lines).count() == 5 - 1 and layout.furniture_lines(df.limit(0), lines).count() == 0
    body = {r["col_name"]: r["body"] for r in layout.bodies(df.where("page_id = 1"), lines).collect() if r["body"]}["website_text"]
    assert "Welcome to Oldham" in body and "crowns" in body and "Gallery" not in body

    class All:
        def judge(self, texts, furniture):
            return [True] * len(texts)

    assert {r["col_name"] for r in layout.furniture_lines(df, lines, skip=All()).collect()} == {"contact_website_text"}


# --- problem 4 ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("text,slot", [
    ("open {{ date }} now", True), ("by %CITY% road", True), ("a <?= $x ?> b", True), ("the [[name]] joins", True), ("*|CITY|* oaks", True), ("see <city> and", True), ("as TODO: owner said", True), ("(undefined price) kilometres", True),
    ("the word [sic] stays", False), ("the {Kelton 1891} edition", False), ("100 % of it", False), ("a <b>bold</b> word", False), ("it costs 5 # or 6", False),
])
def test_slots(text, slot):
    assert bool(residue.SLOT.search(text)) is slot


@pytest.fixture(scope="module")
def statuses(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/website.parquet").where("website_text is not null").select("website", "website_text", "website_text_status").collect()
    return [(str(r[0]), r[1], r[2]) for r in rows]


def surely(text, away):
    """True for a case and False for a page that phrases and shapes tell for sure, else None. They are no features of the classifiers."""
    s, f = residue.sentences(text, away)
    low = " ".join(s).lower()
    words = len(low.split())
    marked = f[:, :2].any() or bool(residue.FILLER.search(low))
    if marked or residue.MESSAGE.search(low) and words < 20:
        return True
    return False if s and not residue.MESSAGE.search(low) and words > 60 else None


def test_classifier_on_unseen_hosts(lines, statuses):
    half = lambda h: sum(map(ord, h)) % 2
    model = residue.Model(lines).fit([(t, s) for h, t, s in statuses if half(h)][:2500])
    held = [t for h, t, s in statuses if not half(h) and s == "success"]
    sure = [surely(t, f) for t, f in zip(held, lines.furniture(held))]
    case = model.judge(held)
    at = [k for k, x in enumerate(sure) if x is not None]
    assert sum(sure[k] for k in at) > 80 and sum(bool(case[k]) == sure[k] for k in at) / len(at) > 0.98


def test_classifier_on_wordings_it_was_not_told(lines, statuses, monkeypatch):
    """Every second phrase labels the sample; cases that only the other phrases tell are still found by words they share."""
    full = residue.FILLER, residue.MESSAGE
    held = [t for h, t, s in statuses if not sum(map(ord, h)) % 2 and s == "success"]
    sure = [surely(t, f) for t, f in zip(held, lines.furniture(held))]
    alternatives = [re.split(r"\|(?![^(]*\))", x.pattern) for x in full]
    for name, parts in zip(("FILLER", "MESSAGE"), alternatives):
        monkeypatch.setattr(residue, name, re.compile("|".join(parts[::2])))
    model = residue.Model(lines).fit([(t, s) for h, t, s in statuses if sum(map(ord, h)) % 2][:2500])
    fewer = [surely(t, f) for t, f in zip(held, lines.furniture(held))]
    only = [t for t, a, b in zip(held, sure, fewer) if a and not b]
    found = model.judge(only).mean()
    assert len(only) > 10 and found > 0.3


def test_messages_beside_content_are_no_case(spark, lines, statuses):
    model = residue.Model(lines).fit([(t, s) for _, t, s in statuses[:4000]])
    prose = "The path from Alton to Belham crosses the old moor and passes 12 kilns. Schools from Corby come here to fly a kite. Most of the oaks near Delham were planted after 1820. "
    texts = [prose + "Room 4 shows an artwork called Page Not Found, made of oaks.", "Error 404: the page you asked for was not found.", "Please enable JavaScript to run this app.", prose + "Lorem ipsum dolor sit amet.", prose.replace("kilns", "{{ name }}"), "", " \n ", prose * 800]
    assert model.judge(texts).tolist() == [False, True, True, True, True, False, False, False]
    df = clash(spark.createDataFrame([(i, t, "success") for i, t in enumerate(texts)] + [(99, None, "success"), (None, texts[1], "success"), (98, texts[1], None), (1, texts[1], "success")], "page_id long, website_text string, website_text_status string"))
    assert sorted(r[0] for r in residue.residue_pages(df, model=model).collect()) == [1, 1, 2, 3, 4]
    assert residue.residue_pages(df.limit(0)).count() == 0


# --- problem 5 ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("label,lang", [("en", "en"), ("eng_Latn", "en"), ("EN", "en"), ("pt-BR", "pt"), (" de_DE ", "de"), ("deu", "de"), ("und", None), ("mul", None), ("", None), (None, None), ("zxx_Zzzz", None)])
def test_labels(spark, label, lang):
    assert spark.createDataFrame([(label,)], "l string").select(tongues.label_language(F.col("l"))).first()[0] == lang


@pytest.fixture(scope="module")
def model(releases):
    return tongues.Tongues(tongues.samples(releases))


def test_model_is_a_distribution(model):
    """The probabilities of all continuations of a start sum to about one for a language that has seen it."""
    import numpy as np

    letters = "abcdefghijklmnopqrstuvwxyzéèàçùœâêîôûäëïöü' "
    s = model._words(["le" + c for c in letters.strip()])
    base = model._words(["le"])
    j = model.names.index("fr")
    assert np.isfinite(s).all() and np.exp(s[:, j] - base[0, j]).sum() < 3


def test_held_out_accuracy(spark, model):
    """Rows that no model was fitted on, of a table with ten times as many: their language and how sure it is."""
    fitted = {t for ts in tongues.samples(spark.read.parquet("/root/testdata/sf0.01/release_rows.parquet")).values() for t in ts}
    rows = spark.read.parquet("/root/testdata/sf0.1/release_rows.parquet").where("length(text) > 60").select("text", tongues.label_language(F.col("language")).alias("l")).where("l is not null").limit(3000).collect()
    rows = [r for r in rows if r["text"] not in fitted]
    read = model.read([tongues.segments(r["text"]) for r in rows])
    right = [x[1] == r["l"] for r, found in zip(rows, read) for x in found]
    sure = [x[2] for found in read for x in found]
    assert len(right) > 500 and sum(right) / len(right) > 0.94  # labels themselves are wrong in some rows of a hundred
    assert abs(sum(right) / len(right) - sum(sure) / len(sure)) < 0.06
    assert sum(x[1] == tongues.UNKNOWN for found in read for x in found) < 0.01 * len(right)


def test_mislabelled_rows(spark, releases, model):
    by = {r["l"]: r["t"] for r in releases.select(tongues.label_language(F.col("language")).alias("l"), F.col("text").alias("t")).where("length(t) > 200").collect() if r["l"] and model.language(r["t"]) == r["l"]}
    en, de, ja = by["en"], by["de"], by["ja"]
    rows = [(1, "en", en), (2, "de", en), (3, None, de), (4, "en-GB", en), (5, "en", en + " " + de), (6, "ja", ja), (7, "en", None), (8, None, ""), (9, None, "123 456"), (None, None, en), (2, "de", en), (10, "en", en * 300)]
    df = clash(spark.createDataFrame(rows, "example_id long, language string, text string"))
    got = sorted((r["row_id"], r["lang"]) for r in tongues.mislabelled(df, model, "t").collect())
    assert got == [(2, "en"), (2, "en"), (3, "de"), (5, "de"), (5, "en")]
    seg = tongues.segment_languages(df, model).where("id = 5").collect()
    assert {r["lang"] for r in seg} == {"en", "de"} and all(0.5 <= r["confidence"] <= 1 for r in seg)
    assert tongues.mislabelled(df.limit(0), model, "t").count() == 0
    assert tongues.Tongues({}).read([["some text"]]) is not None


# Sentences of the tests' own, in languages of which there is no model.
FOREIGN = [
    "Malá chalupa stojí na kraji vesnice u lesa. Děti si hrají na louce a večer se vracejí domů k babičce.",
    "Vanha mylly seisoo joen rannalla ja sen vieressä kasvaa kaksi suurta koivua. Kylän lapset leikkivät illalla pihalla.",
    "Eski değirmen nehrin kıyısında duruyor ve yanında iki büyük kavak ağacı var.", "A régi malom a folyó partján áll, mellette két nagy nyárfa nő.",
    "Moara veche stă pe malul râului, iar lângă ea cresc doi plopi mari.", "Ο παλιός μύλος βρίσκεται στην όχθη του ποταμού.", "Старий млин стоїть на березі річки, а поруч ростуть дві великі тополі.",
]
KNOWN = {
    "en": "The old mill stands by the river and two large birches grow next to it.", "de": "Die alte Mühle steht am Fluss, und daneben wachsen zwei große Birken.",
    "fr": "Le vieux moulin se trouve au bord de la rivière et deux grands bouleaux poussent à côté.",
}


def test_unknown_languages_are_rejected(spark, model):
    texts = [*FOREIGN, *KNOWN.values(), "123"]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "example_id long, text string, language string")
    got = tongues.segment_languages(df, model, whole=True).collect()
    whole = {r["id"]: (r["lang"], r["confidence"]) for r in got if r["segment_no"] is None}
    lost = [i for i in range(len(FOREIGN)) if whole[i][0] == tongues.UNKNOWN]
    assert len(lost) >= len(FOREIGN) - 1  # fitted on the few rows of the small table
    assert [whole[len(FOREIGN) + k][0] for k in range(3)] == list(KNOWN) and whole[len(texts) - 1] == (None, 0.0)
    # a text in none of the languages is no case of any of them
    found = {r["row_id"]: r["lang"] for r in tongues.mislabelled(df, model, "t").collect()}
    assert not set(lost) & set(found) and all(found[len(FOREIGN) + k] == x for k, x in enumerate(KNOWN))


def test_fit_counts_all_labelled_texts(spark):
    """A character of its own in each of many texts: the model of their language knows them all, whether fitted in memory or where the table lies."""
    own = [chr(0x4E00 + k) for k in range(700)]
    rows = [("de", f"Die alte Mühle steht am Fluss {c} und daneben wachsen zwei große Birken.") for c in own] + [("en", f"The old mill stands by the river and {k} birches grow there.") for k in range(700)]
    df = clash(spark.createDataFrame([*rows, (None, "x"), ("de", None), ("de", ""), ("en", "12")], "language string, text string").repartition(5))
    a, b = tongues.Tongues(tongues.samples(df)), tongues.fitted(df)
    for model in (a, b):
        j = model.names.index("de")
        assert (model._words(own)[:, j] > model._words([chr(0x6E00)])[0, j]).all()
    assert a.names == b.names == ["en", "de"] and a.slope == b.slope and (a.limit == b.limit).all() and (a.apart == b.apart).all()
    for x in ("alpha_key", "alpha", "gamma_key", "gamma"):
        assert np.array_equal(getattr(a, x), getattr(b, x))
    assert tongues.fitted(df.limit(0)).names == []


def test_segments_of_all_texts(spark):
    from cartolex.llm.queries import p5_segments

    got = p5_segments(spark, str(SF01)).collect()
    for name, id_col, col in (("release_rows", "example_id", "text"), ("website", "page_id", "website_text")):
        ids = sorted(r[0] for r in spark.read.parquet(f"{SF01}/{name}.parquet").where(f"{col} is not null").select(id_col).collect())
        assert sorted(r["row_id"] for r in got if r["tab_name"] == name and r["segment_no"] is None) == ids
        assert any(r["tab_name"] == name and r["segment_no"] is not None for r in got)
    assert all(0 <= r["confidence"] <= 1 and (r["lang"] is not None or r["confidence"] == 0) for r in got)


# --- problem 10 --------------------------------------------------------------------------------------------------

ARTICLE = "The path from Alton to Belham crosses the old moor and passes twelve kilns. In Alton people still feed the ducks beside the mill. It takes seven minutes to walk from Alton to the dune. Schools from Alton come here to fly a kite. "


def test_long_periods():
    terms = "cabin tent barn kiln oak lake ferry mill pond garden ridge farm shop hotel".split()
    towns = ["Oldham", "Great Alton", "Corby"]
    cycle = " ".join(f"the {a} of {b}" for a, b in zip(terms, terms[1:]))
    for text in (
        "Book the wooden cabin of Oldham by the lake for your family. " * 100,
        (cycle + " ") * 12,
        " ".join(f"Book the wooden cabin of {towns[k % 3]} by the lake for your family and two friends." for k in range(40)),
    ):
        bad, n = stuffing.spam_share(text)
        assert bad > 0.9 * n
    for text in (ARTICLE * 3, ARTICLE * 400):
        bad, n = stuffing.spam_share(text)
        assert bad <= 0.5 * n


@pytest.mark.parametrize("text,spam", [
    (ARTICLE, False), (ARTICLE * 3 + "oaks (3); ponds (4); reeds (7); herons (12); oaks (9); ferns (2)", False),
    ("Oldham campsite cheap Oldham campsite near Oldham campsite best Oldham campsite Oldham campsite online", True),
    ("cabin Alton, tent Belham, campsite Corby, log store Delham, cabin Elton, tent Fareham, campsite Goring, farm shop Hatton", True),
    ("* cabin Alton (a.example)\n* tent Belham (b.example)\n* farm shop Corby (c.example)\n* cabin Delham (d.example)", True),
    ("Want Oldham barn? Get Oldham barn, cheap Oldham barn! Our Oldham barn is the best Oldham barn of every Oldham barn. Ask for Oldham barn and Oldham barn today, because Oldham barn means Oldham barn.", True),
    ("#cabin #cabinAlton #tent #tentBelham #barn #barnCorby #cabinDelham #tent #barn", True), ("Rest in the shade or rest in the shade and then feed the ducks.", False), ("", False), ("word", False),
])
def test_spam(text, spam):
    bad, n = stuffing.spam_share(text)
    assert (n >= 8 and bad > stuffing.MOST_SHARE * n) is spam


def test_autocorrelation_finds_the_beat():
    import numpy as np

    assert stuffing.autocorrelation(np.array([1, 2, 3] * 10))[0] == 3


def test_stuffed_documents(spark):
    spam = "Oldham campsite cheap Oldham campsite near Oldham campsite best Oldham campsite Oldham campsite online"
    df = clash(spark.createDataFrame([(1, spam), (1, spam), (2, ARTICLE), (3, None), (4, ""), (None, spam), (5, spam + " " + ARTICLE * 400)], "doc_id long, text string"))
    assert sorted(r["doc_id"] for r in stuffing.stuffed_documents(df).collect()) == [1, 1]
    assert stuffing.stuffed_documents(df.limit(0)).count() == 0


# --- problem 2 ---------------------------------------------------------------------------------------------------


def test_estimates_on_rows_outside_the_sample(spark):
    """Fitted on one table, judged on texts of a larger one that the fit has not seen: in total, per slice and per row."""
    path = Path("/root/testdata/sf0.1/release_rows.parquet")
    if not path.exists():
        pytest.skip("no test data here")
    small, large = spark.read.parquet(f"{SF01}/release_rows.parquet"), spark.read.parquet(str(path))
    model = budget.fitted(small)
    seen = small.where("text is not null").select("text").distinct()
    fresh = large.where("text is not null and length(text) > 0 and example_id % 4 = 0").join(seen, "text", "left_anti")
    rows = budget.row_tokens(fresh, model).join(fresh.select("example_id", "text"), "example_id").collect()
    true = np.array([len(x) for x in budget.tokenizer().encode_ordinary_batch([r["text"] for r in rows])])
    got = np.array([r["tokens"] for r in rows])
    assert len(rows) > 2000 and abs(got.sum() / true.sum() - 1) < 0.02 and np.mean(abs(got - true) / true) < 0.08
    slices = np.array([f"{r['project']}/{r['lang']}" for r in rows])
    off = {k: got[slices == k].sum() / true[slices == k].sum() - 1 for k in np.unique(slices) if (slices == k).sum() >= 50}
    assert len(off) > 8 and max(map(abs, off.values())) < 0.05, off


@pytest.mark.parametrize("url,host", [("https://WWW.A.example:80/x", "a.example"), ("a.example/b", "a.example"), ("//u@b.example?q", "b.example"), ("", ""), (None, ""), ("http://", "")])
def test_domains(spark, url, host):
    assert spark.createDataFrame([(url,)], "u string").select(budget.domain(F.col("u"))).first()[0] == host


def test_rows_and_slices(spark, releases):
    names = "example_id long, text string, language string, project string, url string"
    rows = [(1, "some words here", "en", "w", "https://a.example/x"), (2, None, None, None, None), (3, "", "en", "w", "A.example"), (None, "mehr Wörter", "deu", "w", None), (1, "some words here", "EN", "w", "a.example"), (5, "long " * 200_000, "xx", "w", None)]
    df = clash(spark.createDataFrame(rows, names))
    fitted = budget.fitted(releases)
    got = budget.row_tokens(df, fitted).collect()
    assert len(got) == 6 and [r["tokens"] for r in got][1:3] == [0, 0] and got[5]["tokens"] > 50_000 and got[3]["lang"] == "de"
    by = {(r["project"], r["lang"], r["domain"]): r["texts"] for r in budget.slices(budget.row_tokens(df, fitted)).collect()}
    assert by[("w", "en", "a.example")] == 3 and by[("", "", "")] == 1
    assert budget.slices(budget.row_tokens(df.limit(0), budget.fitted(df.limit(0)))).count() == 0


def test_random_text_breaks_nothing():
    rng = random.Random(2)
    for _ in range(60):
        t = "".join(rng.choice("ab .,;|/\n*#{}[]<>%:=-–…»語ß1 ​") for _ in range(rng.randint(0, 300)))
        away = layout.Lines().furniture([t])[0]
        assert len(layout.weak_furniture(t)) == len(away) == t.count("\n") + 1
        bad, n = stuffing.spam_share(t)
        assert 0 <= bad <= n
        residue.sentences(t, away)
        tongues.segments(t)
        layout.render(t)
