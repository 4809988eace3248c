"""HTML extraction, quality rules and chat formatting against small cases and brute force."""

import re
from collections import defaultdict

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from gridtide.llm import chat, html_text, quality_rules
from gridtide.llm.html_text import main_text

PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class="ad">Buy <b>now</b></div>
<div id="content"><h2>Head</h2><p>First <a href=x>link</a>   text &amp; more.<p>Second &#x41;<br>line.<ul><li>One<li>Two</ul>
<div class="comments"><p>A reader says much more than the article does, at length and in vain.</p></div></div>
<aside>Other</aside><form>Name <input></form><div class="cookie-notice">We use cookies</div><footer>&copy; Foot</footer>"""


def test_article_only():
    assert main_text(PAGE) == "Head\n\nFirst link text & more.\n\nSecond A line.\n\nOne\n\nTwo"


def test_broken_pages():
    for page, text in [
        (None, ""), ("", ""), ("<", ""), ("a < b", "a < b"), ("<p>only", "only"), ("<script>x", ""), ("<!-- open", ""),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, "deep"), ("<b><i>t</b>u</i>", "tu"), ("text <a href='cut", "text"),
    ]:
        assert main_text(page) == text


SAID = "A sentence of the article that says at some length what it has to say. " * 6


def test_names_alone_cut_no_article():
    text = SAID.strip()
    for page in (
        f'<div class="content with-sidebar"><article><p>{SAID}</article></div>',
        f'<div id="page" class="has-menu"><p>{SAID}</div>',
        f'<div class="post share-enabled"><p>{SAID}</div>',
        f'<div class="sidebar"><article><p>{SAID}</article></div>',
        f'<form id="aspnet"><div><p>{SAID}</div></form>',
        f'<div class="x hidden y" title="not hidden here"><p>{SAID}</div><div hidden>unseen</div>',
        f'<div data-role="menu"><p>{SAID}</div>',
        f'<article><p>{SAID}<div class="share">Share <a href=x>here</a></div></article><div id=comments><p>{SAID * 9}</div>',
        f'<article><p>{SAID}</article><form>Name <input></form><footer>Foot</footer>',
    ):
        assert main_text(page) == text, page
    parts = f'<article><p>{SAID}<section id="discussion"><h2 id="related-work">Related</h2><p>{SAID}</section><p class="notice">Mind this.</article>'
    assert main_text(parts) == f"{text}\n\nRelated\n\n{text}\n\nMind this."
    assert main_text("<article><h1>Short</h1></article><footer>A footer that is longer than the article</footer>") == "Short"


def remarks(n, tag="div", words=12):
    return "".join(f"<{tag} class=c><b>Reader {i}</b><p>{'I do not agree with this at all. ' * (words // 6)}</p></{tag}>" for i in range(n))


def test_comments_go_whatever_their_size():
    text = SAID.strip()
    short = "A notice of a few words that says what it has to say."
    for n in (1, 5, 8, 20, 60):
        for page in (
            f'<article><p>{SAID}</p><section id="comments"><h3>Comments</h3>{remarks(n)}</section></article>',
            f'<article><p>{SAID}</p></article><section id="comments">{remarks(n)}</section>',
            f'<div class="post"><p>{SAID}</p></div><div class="comments">{remarks(n, "li")}</div>',
            f'<div class="post"><p>{SAID}</p><ol class="comment-list">{remarks(n, "li")}</ol></div>',
            f'<main><p>{SAID}</p><div id="disqus">{remarks(n)}</div></main>',
        ):
            assert main_text(page) == text, page[:200]
        page = f'<article><p>{short}</p></article><div class="comments">{remarks(n, words=60)}</div>'
        assert main_text(page) == short
    plain = "".join(f"<p>{'I do not agree with this. ' * 8}</p>" for _ in range(20))
    assert main_text(f'<article><p>{short}</p></article><div class="comments">{plain}</div>') == short
    # the only text of the page stands in what is named like comments
    assert main_text(f'<nav><a href=x>Home</a></nav><div id="comments"><p>{SAID}</p></div>') == text
    assert main_text(f'<h1>Head</h1><div id="respond"><p>{SAID}</p></div>').endswith(text)


def test_a_lone_title_beside_the_text_stays():
    text = SAID.strip()
    assert main_text(f'<body><h1>The title</h1><div class="text"><p>{SAID}</p><p>{SAID}</p></div></body>') == f"The title\n\n{text}\n\n{text}"
    assert main_text(f'<body><header><h1>Site</h1></header><div><p>{SAID}</p><p>{SAID}</p></div></body>') == f"{text}\n\n{text}"


def test_a_dear_rule_comes_after_a_cheap_one_that_rejects_as_much(spark):
    body = " ".join(f"word{i}" for i in range(400))
    texts = spark.createDataFrame([(i, body + (" zzz" if i % 2 else "")) for i in range(300)], "doc_id long, text string").repartition(3)
    has = F.col("text").endswith("zzz")
    dear = F.size(F.array_sort(F.split("text", ""))) > 0
    rules = [quality_rules.Rule("dear", dear & has), quality_rules.Rule("cheap", has)]
    found = {e.name: e for e in quality_rules.estimate(texts, rules)}
    assert found["dear"].rejected == found["cheap"].rejected == 0.5
    assert found["dear"].seconds > 5 * found["cheap"].seconds
    assert [r.name for r in quality_rules.ordered(rules, list(found.values()))] == ["cheap", "dear"]
    assert quality_rules.sampled(texts, "text", 100).count() == 100 and quality_rules.sampled(texts.limit(0), "text", 9).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/pdiv abc&;\"'=!-\n", max_size=80))
def test_never_fails(page):
    text = main_text(page)
    assert text == text.strip()


def test_pages_table(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, 9), (1, "u", PAGE, 9), (None, None, None, None)], "page_id long, url string, html string, text int")
    found = html_text.extracted(pages).collect()
    assert [r.n_chars for r in found] == [len(main_text(PAGE))] * 2 + [0]
    assert html_text.extracted(pages.limit(0)).count() == 0


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    words = WORD.findall(text or "")
    places, covered = defaultdict(list), set()
    for i in range(len(words) - 2):
        places[tuple(words[i : i + 3])].append(i)
    for found in places.values():
        if len(found) > 1:
            covered.update(i + k for i in found for k in range(3))
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_measures_equal_brute_force(spark, docs):
    texts = ["a b a b a b", "a a a a", "x\nx\n \nx", "# $ |\x0bä", "one two three", "a b c d a b c"]
    more = docs.select("doc_id", "text", "n_words").union(spark.createDataFrame([(i + 20, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_words int"))
    for r in quality_rules.judge(more).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == by_hand(r.text)
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert quality_rules.judge(more.limit(0)).count() == 0


def test_order_does_not_change_the_verdict(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rules = quality_rules.standard_rules()
    verdicts = []
    for sign in (1, -1):
        given_ = {r.name: quality_rules.Estimate(r.name, 1.0, sign * i) for i, r in enumerate(rules)}
        verdicts.append({r.doc_id: r.kept for r in quality_rules.judge(docs, rules, estimates=given_).select("doc_id", "kept").collect()})
    assert verdicts[0] == verdicts[1]
    ordered = quality_rules.ordered(rules, [quality_rules.Estimate(r.name, 1.0 + i, 0.5) for i, r in enumerate(rules)])
    assert [r.name for r in ordered] == [r.name for r in rules]


def test_chat_pairs(spark):
    turns = spark.createDataFrame(
        [
            (1, 0, "user", "hi", 5), (1, 1, "assistant", "yes", 5), (1, 2, "user", "ok", 5),
            (2, 0, "user", "hi", 5), (2, 1, "assistant", "no", 5),
            (3, 0, "user", "hi", 5), (4, 0, None, None, 5), (5, 0, "user", "alone", 5),
        ],
        "conv_id long, turn long, role string, text string, chosen int",
    )
    pairs = chat.opening_pairs(turns)
    assert sorted(map(tuple, pairs.collect())) == [(1, 2), (1, 3)]
    found = {r.rejected_id: r for r in chat.format_pairs(chat.with_turns(turns, pairs)).collect()}
    assert found[2].prompt == found[3].prompt == "<|user|>\nhi\n"
    assert found[2].n_shared == 1 and found[2].rejected == "<|assistant|>\nno\n"
    assert [found[2].rejected[a:b] for a, b in found[2].rejected_spans] == ["no\n"]
    assert [found[2].chosen[a:b] for a, b in found[2].chosen_spans] == ["yes\n"]
    assert found[3].rejected == "" and found[3].rejected_spans == []
    absent = chat.format_pairs(chat.with_turns(turns, spark.createDataFrame([(1, 77), (4, 4)], "chosen_id long, rejected_id long")))
    assert {(r.chosen_id, r.n_shared, r.rejected) for r in absent.collect()} == {(1, 0, ""), (4, 1, "")}
    swapped = chat.format_pairs(chat.swapped_endings(turns)).collect()
    assert sorted((r.chosen_id, r.rejected_id, r.n_shared, r.rejected) for r in swapped) == [
        (1, 2, 1, "<|assistant|>\nno\n"), (2, 1, 1, "<|assistant|>\nyes\n"),
    ]
    assert chat.format_pairs(chat.swapped_endings(turns.limit(0))).count() == 0
    assert chat.opening_pairs(turns.limit(0)).count() == 0


def test_every_answered_conversation_has_a_donor(spark):
    """Ids far apart, of any type; the donor is the next conversation with an answer, across all ranges."""
    ids = [i * 97 % 10_007 for i in range(300)]
    data = [(f"c{c:05d}", 0, "user", "q") for c in ids] + [(f"c{c:05d}", 1, "assistant", f"a{c}") for c in ids if c % 3]
    data += [(None, 0, "assistant", "without an id"), ("c00001", 1, "assistant", "tie"), ("c00001", 1, "assistant", "tie")]
    turns = spark.createDataFrame(data, "conv_id string, turn long, role string, text string").repartition(7)
    clashing = turns.withColumns({c: F.lit(1) for c in ("range", "first", "ending", "turns", "last_")})
    found = {r.chosen_id: r.rejected_id for r in chat.swapped_endings(clashing).collect()}
    answered = sorted({c for c, _, role, _ in data if role == "assistant" and c})
    assert found == dict(zip(answered, answered[1:] + answered[:1]))
    one = turns.where("conv_id = 'c00001'")
    assert chat.swapped_endings(one).count() == 0


def test_equal_turn_numbers_are_ordered_by_role_and_text(spark):
    data = [(1, 0, "user", "b", 0), (1, 0, "assistant", "z" * 300_000, 0), (1, 0, "user", "a", 0), (2, 1, "assistant", "y", 0)]
    turns = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, n_shared int")
    pair = {r.chosen_id: r for r in chat.format_pairs(chat.swapped_endings(turns)).collect()}[1]
    assert pair.prompt == "" and pair.rejected == "<|assistant|>\ny\n"
    assert pair.chosen.index("\na\n") < pair.chosen.index("\nb\n") and [b - a for a, b in pair.chosen_spans] == [300_001]


def test_chat_prefix_equals_brute_force(spark, small):
    turns = spark.read.parquet(f"{small}/conversations.parquet")
    held = defaultdict(list)
    for r in turns.orderBy("conv_id", "turn").collect():
        held[r.conv_id].append((r.role, r.text))
    for r in chat.format_pairs(chat.swapped_endings(turns)).collect():
        own = held[r.chosen_id]
        assert r.prompt + r.chosen == "".join(f"<|{a}|>\n{b}\n" for a, b in own)
        assert r.n_shared <= max(i for i, (role, _) in enumerate(own) if role == "assistant")
        assert sum(b - a for a, b in r.chosen_spans) == sum(len(t) + 1 for role, t in own[r.n_shared :] if role == "assistant")
    assert turns.select(F.countDistinct("conv_id")).first()[0] > 1
