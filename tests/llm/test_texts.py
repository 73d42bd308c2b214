"""Personal data, token counts, HTML, chat windows, mixing, classifier and the pipeline."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomstar.llm import chat, html_extract, mixing, pii, quality_classifier, token_counts
from loomstar.llm.queries import op10_chat_formatting, tokenizer_path
from loomstar.llm.shared import table
from tests.llm import helpers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


# ---- personal data -----------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(*m.span(), "email") for m in EMAIL.finditer(text)]
    out += [(*m.span(), "ip") for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(*m.span(), "card") for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [(*m.span(), "phone") for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


def test_base_spans_against_plain_patterns():
    random.seed(5)
    parts = ["1", "22", "255", "256", ".", "@", "a", "b.c", "-", "+", "+1", " ", "(", ")", "4111111111111111", "é", "x_", "0005"]
    for _ in range(20_000):
        text = "".join(random.choice(parts) for _ in range(random.randint(1, 14)))
        assert pii.base_spans(text) == plain_base(text), text


def test_crf_recovers_and_adds_spans():
    weights = pii.train([*pii.EXAMPLES * 3])
    for text, kind, span in [("mail to jo.doe@mail.example.org now", "email", "jo.doe@mail.example.org"),
                             ("from 83.229.25.121 and", "ip", "83.229.25.121"),
                             ("call (202) 555-0143 now", "phone", "(202) 555-0143"),
                             ("card 4111 1111 1111 1112 paid", "card", "4111 1111 1111 1112"),
                             ("the token = \"0a1b2c3d4e5f60718293a4b5c6d7e8f9\" is", "secret", "0a1b2c3d4e5f60718293a4b5c6d7e8f9")]:
        at = pii.atoms(text, 0, len(text))
        found = [(text[at[i][0]:at[j - 1][1]], pii.KINDS[k]) for i, j, k in pii.decode(len(at), pii.candidates(text, at), weights)]
        base, added = pii.find_spans(text, weights)
        assert (span, kind) in found or (span, kind) in [(text[a:b], k) for a, b, k in base + added], text
    for clean in ("in 1999 there were 12 of them", "see chapter 3.4 on page 120", "10 of 20"):
        assert pii.find_spans(clean, weights) == ([], [])


def test_decode_is_the_best_segmentation():
    """Against all sets of disjoint candidate spans."""
    weights = {"a": (1.0, -1.0, 0.0, 0.5, 0.2), "b": (-2.0, 2.0, 0.1, 0.0, 0.0)}
    random.seed(2)
    for _ in range(200):
        n = random.randint(1, 6)
        spans = [(i, j, random.choice([("a",), ("b",), ("a", "b"), ("c",)])) for i in range(n) for j in range(i + 1, n + 1) if random.random() < 0.5]

        def best(start):
            if start >= n:
                return 0.0
            return max([best(start + 1), *(max(pii.scores(f, weights)) + best(j) for i, j, f in spans if i == start)])

        got = sum(pii.scores(f, weights)[k] for i, j, k in pii.decode(n, spans, weights)
                  for f in [max((f for a, b, f in spans if (a, b) == (i, j)), key=lambda f: pii.scores(f, weights)[k])])
        assert got == pytest.approx(best(0))


def test_spans_do_not_depend_on_where_a_region_is_cut(monkeypatch):
    weights = pii.train(list(pii.EXAMPLES) * 3)
    lines = [f"{i} call (202) 555-0{100 + i} or password=hunter{i}hunter{i} or 4111 1111 1111 {1000 + i}" for i in range(60)]
    text = "\n".join(lines)
    (start, end), = pii.regions(text)
    at = pii.atoms(text, start, end)
    whole = [(at[i][0], at[j - 1][1], pii.KINDS[k]) for i, j, k in pii.decode(len(at), pii.candidates(text, at), weights)]
    assert len(at) > 3 * pii.MAX_REGION and sum(k == "secret" for _, _, k in whole) >= 60
    for size in (pii.MAX_REGION, 1, 7, 50, 10**6):
        monkeypatch.setattr(pii, "MAX_REGION", size)
        base, added = pii.find_spans(text, weights)
        assert added == [s for s in whole if all(s[1] <= a or s[0] >= b for a, b, _ in base)]


def test_secrets_are_found_with_and_without_digits(spark, docs):
    """Recall of planted secrets in the documents' own words, and no secret in the words themselves."""
    weights = pii.learn(docs)
    rnd = random.Random(11)
    words = [w for r in docs.limit(50).collect() for w in helpers.space_words(r["text"]) if w.isalpha()]
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    kinds = {
        "digits": lambda: "".join(rnd.choice(letters + "0123456789") for _ in range(rnd.randint(12, 40))) + "7",
        "assigned": lambda: "".join(rnd.choice(letters[:26]) for _ in range(rnd.randint(10, 30))),
        "signs": lambda: "-".join("".join(rnd.choice(letters[:26]) for _ in range(rnd.randint(4, 8))) for _ in range(3)),
    }
    for kind, secret in kinds.items():
        found = 0
        for _ in range(100):
            value, key = secret(), rnd.choice(pii.KEYWORDS)
            sign = "=" if kind == "assigned" else rnd.choice(["=", ": ", ' = "'])
            text = f"{' '.join(rnd.choices(words, k=12))} {key}{sign}{value}{'\"' if sign.endswith(chr(34)) else ''} {' '.join(rnd.choices(words, k=12))}"
            base, added = pii.find_spans(text, weights)
            found += (text.index(value), text.index(value) + len(value), "secret") in added
        assert found >= 90, (kind, found)
    for _ in range(100):
        text = f"{' '.join(rnd.choices(words, k=12))} the key: something {' '.join(rnd.choices(words, k=12))}: {' '.join(rnd.choices(words, k=3))}"
        assert pii.find_spans(text, weights) == ([], []), text


def test_personal_data_rows(spark):
    rows = [(1, None), (2, ""), (3, "a@b.co and 1.2.3.4"), (3, "a@b.co and 1.2.3.4"), (4, "9" * 200_000), (5, "x@" * 50_000), (6, "é +1 (202) 555-0143")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    weights = pii.train(list(pii.EXAMPLES))
    got = pii.personal_data(df, weights=weights).collect()
    assert len(got) == len(rows)
    for r, (i, text) in zip(sorted(got, key=lambda r: r[0]), rows):
        base = plain_base(text or "") if len(text or "") < 1000 else pii.base_spans(text)
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(sum(s[2] == k for s in base) for k in pii.BASE_KINDS)
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in base).encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for a, b, k in base} <= set(r["spans"].split(","))


# ---- token counts ------------------------------------------------------------

def test_token_counts_equal_the_library(spark, docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    counter = token_counts.Counter(tokenizer_path())
    parts = ["a", "the", "ing", "  ", " ", "\n", "\t", "▁", "é", "😀", "中文", "aaa", "====", "</s>", "<0x0A>", "2024", "E", "\x00", "ﬁ", "://", " " * 20]
    random.seed(4)
    for _ in range(3000):
        text = "".join(random.choice(parts) for _ in range(random.randint(0, 30)))
        for size in (1, 4, 1000):
            chunks = [text[i:i + size] for i in range(0, len(text), size)]
            maps = [counter.map_of(token_counts.normalised(c, i == 0)) for i, c in enumerate(chunks)]
            assert (counter.total(maps) if maps else 0) == len(sp.encode(text)), (text, size)
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    rows += [(-1, None), (-2, ""), (-3, "x" * 5000), (-3, "x" * 5000), (None, "a  b " * 900), (-4, "😀" * 2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for chunk in (97, 1 << 16):
        got = sorted((tuple(r) for r in token_counts.token_counts(df, tokenizer_path(), chunk=chunk, limit=100).collect()), key=str)
        want = [(i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 100) for i, t in rows]
        assert got == sorted(want, key=str)


def test_composition_is_associative():
    counter = token_counts.Counter(tokenizer_path())
    text = token_counts.normalised("the  quick brown fox  jumps over▁the lazydogandmore   ", True)
    a, b, c = counter.map_of(text[:9]), counter.map_of(text[9:13]), counter.map_of(text[13:])
    assert counter.total([counter.compose(counter.compose(a, b), c)]) == counter.total([counter.compose(a, counter.compose(b, c))])


def test_transducer_forgets_without_harm(monkeypatch):
    monkeypatch.setattr(token_counts, "MAX_STATES", 5)
    small, whole = token_counts.Counter(tokenizer_path()), token_counts.Counter(tokenizer_path())
    for w in ("▁hello", "▁straße", "▁unbelievable", "▁1234567", "▁\x01x"):
        assert small.transducer.count(w) == whole.transducer.count(w)


# ---- HTML --------------------------------------------------------------------

LONG = "This is a paragraph that goes on for a while, so that it has the words of a text and is as long as it has to be."


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p", ""), ("<script>x", ""),
    (f"<nav><a href=x>Home</a></nav><article><h1>T&eacute;st &amp; more</h1><p>{LONG}<p>Short.</article><footer>f</footer>",
     f"Tést & more\n{LONG}\nShort."),
    (f"<div class='ad'>{LONG}<article><p>{LONG}</p><div id=comments><article>{LONG}</article></div></article>", LONG),
    (f"<div><p>{LONG}</p><p>Short.</p><form>{LONG}</form><div class='cookie-notice'>{LONG}</div></div>", f"{LONG}\nShort."),
    (f"<article><p>a<br>b <b>c</b>\n d</p><!-- {LONG} --><p>x<br><br>y</p><style>z</style></article>", "a b c d\nx\ny"),
    ("<article><p>qqq zzz</p></article>", "qqq zzz"),
    (f"<div><ul><li><a href=x>one</a></li><li><a href=y>two</a></li></ul><p>{LONG}</p></div>", LONG),
])
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


@pytest.mark.parametrize("name", sorted(html_extract.MUTE))
def test_unclosed_elements_keep_the_article(name):
    start, end = f"<{name} class=x>", f"</{name}>"
    for page in (f"<div>{start}Go</div><article><p>{LONG}</p></article>", f"<body>{start}<div><p>{LONG}</p></div>",
                 f"<body>{start}<p>{LONG}</p><p>{start}gone{end}</p>", f"<h1>{start}Go</h1><p>{LONG}</p>{end}"):
        assert LONG in html_extract.main_text(page), page
    assert html_extract.main_text(f"<article><p>{LONG} {start}gone<p>gone</p><hr>{end}and on</p></article>") == f"{LONG} and on"
    assert html_extract.main_text(f"<div>{start}{LONG}</div><article>{LONG}</article>{end}") == LONG or name == "template"
    assert html_extract.main_text(f"<article><p>{LONG}</p><script>'{start}'</script>{start}<h2>{LONG}</h2>{end}</article>") == LONG


RUSSIAN = "Вчера вечером учёные института сообщили, что новая станция на севере острова впервые передала данные о погоде."
CHINESE = "昨天晚上研究所的科学家宣布，北岛的新气象站首次传回了完整的观测数据，未来几个月将继续测试设备。"
CODE = "while (k < n) { total[k] = base[k] * factor + offset[k]; emit(total[k], k, channel); k = next(k, step); }"


@pytest.mark.parametrize("text", [RUSSIAN, CHINESE])
def test_other_languages_without_article_tags(text):
    page = (f"<div><ul><li><a href=x>{text}</a></li></ul></div><div class=sidebar><p>{text}</p></div>"
            f"<div><p>{text}</p><p>{text[:20]}</p><p>{text}</p></div><div id=footer>{text} All rights reserved by the owner.</div>")
    assert html_extract.main_text(page) == f"{text}\n{text[:20]}\n{text}"


def test_code_between_accepted_blocks():
    code = CODE.replace("<", "&lt;")
    page = f"<div><p>{LONG}</p><pre>{code}</pre><div class=ad>{LONG}</div><pre>{code}</pre><p>{LONG}</p></div><div>{code}</div><div>End.</div>"
    assert html_extract.main_text(page) == f"{LONG}\n{CODE}\n{CODE}\n{LONG}"


PARTS, WHOLE = f"<p>{LONG}</p>" * 3, "\n".join([LONG] * 3)
SIDE = f"<div class=sidebar><p>{LONG} aside</p></div>"


@pytest.mark.parametrize("page,text", [
    (f'<div class="content with-sidebar">{PARTS}</div>', WHOLE),
    (f'<div class="post social">{PARTS}{SIDE}</div>', WHOLE),
    (f'<div class="blog-widget entry">{PARTS}</div>{SIDE}', WHOLE),
    (f'<div id="search-results">{PARTS}</div>', WHOLE),
    (f'<form action=x><div class=top><a href=x>Home</a></div>{PARTS}{SIDE}<input></form>', WHOLE),
    ("<article><h1>T</h1><p>Short one.</p><p><a href=x>link only here</a></p></article>", "T\nShort one."),
    (f"<main>{PARTS}</main><section><article>{LONG} teaser</article></section><aside><article>{LONG} x</article></aside>", WHOLE),
    (f"<article>{PARTS}</article><aside><article>{LONG} x</article></aside>", WHOLE),
    (f'<article><div class="post social">{PARTS}</div><div class="share">{LONG}</div></article>', WHOLE),
    (f"<aside><article>{PARTS}</article>", WHOLE),
    (f"<div class=content>{PARTS}</div><div class='newsletter-signup'>{LONG}</div>", WHOLE),
])
def test_names_never_delete_most_of_a_page(page, text):
    assert html_extract.main_text(page) == text


def test_extract_empty_table_and_other_columns(spark):
    rows = table(spark, SF, "pages").selectExpr("page_id", "url", "html", "'x' AS text", "1 AS n_chars")
    plain = html_extract.extract(table(spark, SF, "pages"))
    assert html_extract.extract(rows).exceptAll(plain).count() == 0
    assert html_extract.extract(rows.where("false")).collect() == []


def test_extract_whole_table(spark):
    """The pages' own template: everything inside the article, block by block."""
    from html import unescape

    rows = table(spark, SF, "pages")
    want = {}
    for r in rows.collect():
        inside = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        parts = [" ".join(unescape(re.sub("</?(?:b|br)>", " ", p)).split()) for p in re.split("</?(?:p|h1)>", inside)]
        want[r["page_id"]] = "\n".join(p for p in parts if p)
    got = html_extract.extract(rows).collect()
    assert {r["page_id"]: r["text"] for r in got} == want and all(r["n_chars"] == len(r["text"]) for r in got)
    odd = spark.createDataFrame([(None, None, None), (1, "u", "<p>x")], "page_id long, url string, html string")
    assert html_extract.extract(odd).count() == 2


def test_extraction_time_follows_the_page_length():
    for page in ("<" * 100_000, '<a "' * 30_000, "<div>" * 30_000 + "</span>" * 30_000, "<!--" * 30_000, "<br>" * 50_000):
        html_extract.main_text(page)


# ---- chat --------------------------------------------------------------------

def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


CHATS = [(1, 2, "assistant", "late"), (1, 1, "user", None), (1, 0, "system", "be <|im_end|> <\\| <|"), (2, None, "user", "x\ny"), (2, 0, "assistant", ""),
         (None, 0, "assistant", "null id"), (3, 0, "user", "q <"), (3, 0, "user", "q <"), (3, 1, "a\\n\n<|b", "|>")]
CHATS += [(4, i, ("system", "user", "assistant")[i and 1 + i % 2], " ".join(f"t{i}_{k}" for k in range(1 + (i * 37) % 90))) for i in range(120)]


def plain_chat(rows):
    out = {}
    for c in {r[0] for r in rows}:
        turns = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c)
        target = "".join(t for _, _, r, t in turns if r == "assistant")
        out[c] = (len(turns), digest("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(target), digest(target))
    return out


def test_chat_round_trip(spark):
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    windows = chat.windows(df)
    got = {r[0]: tuple(r)[1:5] for r in chat.read_back(windows).collect()}
    assert got == plain_chat(CHATS)
    plan = chat.read_back(windows)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert chat.read_back(chat.windows(df.limit(0))).count() == 0


def test_chat_windows_keep_the_budget(spark):
    df = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string").where("conv_id = 4")
    rows = sorted(chat.windows(df, budget=400, history=80).collect(), key=lambda r: r["window"])
    assert len(rows) > 5
    for r in rows:
        pieces = r["formatted"].split("<|im_end|>\n")[:-1]
        assert pieces[0].startswith("<|im_start|>system\n")
        assert sum(len(p.split("\n", 1)[1].split()) + chat.OVERHEAD for p in pieces) <= 400
        assert r["n_repeated"] < len(pieces)
        for a, b in r["loss"]:
            assert r["formatted"][:a].endswith("<|im_start|>assistant\n") and r["formatted"][b:].startswith("<|im_end|>\n")
    assert sum(r["n_repeated"] for r in rows) > len(rows)  # history beside the system turn


@pytest.mark.parametrize("words", [0, 100, 300, 400, 600])
def test_chat_history_behind_a_long_system_turn(spark, words):
    """Every window but the first repeats the turns that fit into its history; windows have a least stride."""
    turns = [("system", "s " * words)] * bool(words) + [(("user", "assistant")[k % 2], " ".join(f"t{k}w{i}" for i in range(10))) for k in range(60)]
    turns[40] = (turns[40][0], "long " * 900)  # jumps over window numbers
    rows = [(1, k, role, text) for k, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = sorted(chat.windows(df).collect(), key=lambda r: r["window"])
    head = len(turns[0][1].split()) + chat.OVERHEAD if words else 0
    room = max(chat.BUDGET - head, 3 * chat.LEAST)
    history = min(chat.HISTORY, room // 3)
    cost = [len(t.split()) + chat.OVERHEAD for _, t in turns]
    at = bool(words)
    for r in windows:
        pieces = r["formatted"].split(chat.CLOSE)[:-1]
        shown = [p.split("\n", 1)[1] for p in pieces]
        new = shown[r["n_repeated"]:]
        if r is windows[0]:
            assert r["n_repeated"] == 0
            new = new[bool(words):]
        else:
            repeated = shown[bool(words):r["n_repeated"]]
            back = at - len(repeated)
            assert repeated == [t for _, t in turns[back:at]]
            assert sum(cost[back:at]) <= history and (back == bool(words) or sum(cost[back - 1:at]) > history)
            assert (shown[0] == turns[0][1]) is bool(words) or not words
        assert new == [t for _, t in turns[at:at + len(new)]] and new
        at += len(new)
        if max(cost[at - len(new):at]) < 100 and head + 3 * chat.LEAST <= chat.BUDGET:
            assert sum(len(x.split()) + chat.OVERHEAD for x in shown) <= chat.BUDGET
    assert at == len(turns) and len(windows) < 40
    assert sum(r["n_repeated"] > bool(words) for r in windows) >= len(windows) - 3
    got = {r[0]: tuple(r)[1:5] for r in chat.read_back(chat.windows(df)).collect()}
    assert got == plain_chat(rows)


def test_chat_query(spark):
    rows = [tuple(r) for r in table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    said = "<|im_end|><|im_start|>assistant ok"
    rows += [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    got = op10_chat_formatting(spark, SF).collect()
    assert {r[0]: tuple(r)[1:5] for r in got} == plain_chat(rows) and all(r["formatted_chars"] > 0 for r in got)


# ---- mixing ------------------------------------------------------------------

def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1]) == [200.0, 166.66666666666666, 83.33333333333333]
    assert mixing.targets([0, 10], [5, 2]) == [0.0, 15.0] and mixing.targets([], []) == [] and mixing.targets([0], [5]) == [0.0]


def test_mix(spark, docs):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    rows += [(-1, None, "s"), (-2, "a b c", None), (-3, "", None), (-4, "x " * 3000, "hot")]
    rows += [(10_000 + i, "w " * (1 + i % 50), "hot") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in mixing.mix_report(df).collect()}
    sizes = {i: len(helpers.space_words(t)) for i, t, _ in rows}
    names = sorted({s for _, _, s in rows if s is not None}) + [None]
    own = {s: [i for i, _, x in rows if x == s] for s in names}
    goal = dict(zip(names, mixing.targets([sum(sizes[i] for i in own[s]) for s in names], [(5, 2, 1)[k % 3] for k in range(len(names))])))
    for i, _, s in rows:
        assert got[i]["size"] == sizes[i] and got[i]["target"] == goal[s] and 0 <= got[i]["taken"] <= 2 * sizes[i]
    for s in names:
        assert abs(sum(got[i]["taken"] for i in own[s]) - goal[s]) <= 1
    assert {i: r["taken"] for i, r in got.items()} == {r["doc_id"]: r["taken"] for r in mixing.mix_report(df.repartition(7)).collect()}
    mix = mixing.mixed(df).groupBy("doc_id").agg(F.sum("taken").alias("t")).collect()
    assert {r[0]: r[1] for r in mix} == {i: r["taken"] for i, r in got.items() if r["taken"]}
    assert all(len(helpers.space_words(r["text"])) == r["taken"] for r in mixing.mixed(df).collect())
    assert mixing.mix_report(df.limit(0)).count() == 0


def test_mix_without_ids(spark):
    """Rows without an id, and equal ones, are taken one by one: a source's budget ends in one row."""
    rows = [(i if i % 3 else None, " ".join(f"w{i}x{k}" for k in range(1 + i * 7 % 90)), "abc"[i % 5 % 3]) for i in range(900)]
    rows += [(None, "one two three four five", "d")] * 40 + [(None, "six", "e")] * 1000
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    size = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in "abcde"}
    goal = dict(zip("abcde", mixing.targets([size[s] for s in "abcde"], [5, 2, 1, 5, 2])))
    mix = mixing.mixed(df).collect()
    whole = {t for _, t, _ in rows}
    for s in "abcde":
        assert abs(sum(r["taken"] for r in mix if r["source"] == s) - goal[s]) <= 1
        assert sum(r["text"] not in whole for r in mix if r["source"] == s) <= 1
    report = mixing.mix_report(df).groupBy("source_size").agg(F.sum("taken").alias("t")).collect()
    assert {r["source_size"]: r["t"] for r in report} == {size[s]: sum(r["taken"] for r in mix if r["source"] == s) for s in "abcde"}


@pytest.mark.parametrize("n", [0, 1, 8, 20_000])
def test_targets_of_many_sources(spark, n):
    """Numbers, weights and targets of any number of sources, without a driver row each."""
    rnd = random.Random(n)
    rows = [(f"host{i}.example" if i else None, rnd.choice([0, 1, 5, 1000, rnd.randrange(10**6)]), rnd.getrandbits(60)) for i in range(n)]
    df = spark.createDataFrame(rows, "source string, size long, key long")
    got = {r["source"]: (r["sid"], r["source_size"], r["target"]) for r in mixing.with_targets(mixing.ordered_sources(df)).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or ""))
    goal = mixing.targets([r[1] for r in order], [mixing.WEIGHTS[i % 3] for i in range(n)])
    assert got == {r[0]: (i, r[1], goal[i]) for i, r in enumerate(order)}
    spent = mixing.plan(df).selectExpr("sum(epochs * source_size) AS w", "count(1) AS n").first()
    assert spent["n"] == n and (spent["w"] or 0) <= sum(goal) + 1


# ---- classifier --------------------------------------------------------------

def test_classifier(spark):
    """Held-out accuracy, and shrinkage: a sparse host's rate stays near the global one."""
    random.seed(3)

    def text(good):
        return " ".join(random.choice(["alpha", "beta", "gamma", "delta", "word", "text"]) + ("" if good else random.choice(["##", "&&", ""])) for _ in range(80))

    rows = [(i, text(i % 3 > 0), "hosta" if i % 3 else "hostb", "en") for i in range(600)]
    rows += [(900, text(True), "rare", "en"), (901, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(300)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality_classifier.classify(docs, labels).collect()}
    assert len(got) == len(rows)
    assert sum(got[i]["kept"] == (i % 3 > 0) for i in range(300, 600)) > 290
    assert got[1]["host_posterior"] > 0.9 > got[900]["host_posterior"] > got[0]["host_posterior"]
    none = quality_classifier.classify(docs, labels.limit(0)).collect()
    assert len(none) == len(rows) and all(r["evidence"] == 0 for r in none)
    host, path = quality_classifier.split_url(F.col("u"))
    urls = spark.createDataFrame([("https://www.A.example.com:80/x/y?z",), ("http://b.org",), (None,)], "u string")
    assert [tuple(r) for r in urls.select(host, path).collect()] == [("a.example.com", "a.example.com/x"), ("b.org", "b.org/"), (None, None)]


def test_classifier_learns_toxic_words(spark):
    """Held-out toxic rows of good shape go, by the words that labelled toxic rows have."""
    random.seed(5)
    plain, bad = ["alpha", "beta", "gamma", "delta", "word", "text"], ["trash", "idiot", "scum"]

    def text(toxic):
        w = [random.choice(plain) for _ in range(80)]
        return " ".join([*w[:40], *(random.sample(bad if toxic else plain, 2)), *w[40:]])

    rows = [(i, text(i % 5 == 0), "host", "en") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(300)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["kept"] for r in quality_classifier.classify(docs, labels).collect()}
    assert sum(got[i] == (i % 5 > 0) for i in range(300, 600)) > 295
    assert "repeat_ratio" in quality_classifier.USED


# ---- pipeline ----------------------------------------------------------------

def test_pipeline_stages(spark, docs):
    """Every stage on its predecessor's rows, against plain Python."""
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "source_mixing"]
    texts = lambda df: sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())
    stages = dict(corpus_pipeline.STAGES)
    before = texts(docs)
    good = stages["quality_rules"](spark, docs, SF)
    kept = texts(good)
    for i, t in set(before) - set(kept):
        n, _, _, _, rep = helpers.base_counts(t)
        assert n < 50 or 100 * rep > 50 * n or re.search(r"[#*$%&|<>!]", t) or len(set(t.split())) < 0.8 * n
    lines = stages["line_dedup"](spark, good, SF)
    want = helpers.line_dedup(kept)
    assert texts(lines) == sorted((i, t) for i, (_, d, t) in want.items() if not d or helpers.space_words(t))
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect())
    near = stages["near_dedup"](spark, lines, SF)
    assert {i for i, _ in texts(near)} == {i for i, (_, c) in helpers.components(texts(lines)).items() if i == c}
    clean = stages["decontamination"](spark, near, SF)
    items = [(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]
    assert {i for i, _ in texts(clean)} == {r[0] for r in helpers.contamination(texts(near), items) if not r[-1]}
    for df in (good, lines, near, clean):
        assert df.columns == docs.columns
    mixed = stages["source_mixing"](spark, clean, SF).collect()
    assert 1.2 * sum(len(t.split()) for _, t in texts(clean)) < sum(r["taken"] for r in mixed)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, mixed))
