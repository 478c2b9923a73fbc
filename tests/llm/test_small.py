import random

import pytest

from siltstone.llm import leaks, markup, neardup, pairs, pieces, quality, scans, sentences, splits


# --- p1


def jaccard_pairs(rows):
    sets = {k: set(neardup.WORD.findall(f"{q or ''} {a or ''}".lower())) for k, q, a in rows}
    keys = sorted(sets)
    return {(x, y) for i, x in enumerate(keys) for y in keys[i + 1 :] if sets[x] and len(sets[x] & sets[y]) >= 0.8 * len(sets[x] | sets[y]) - 1e-9}


def test_near_pairs_brute(spark, monkeypatch):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)]
    rows = []
    for k in range(300):
        if rows and rng.random() < 0.6:
            w = f"{rng.choice(rows)[1] or ''} {rng.choice(words)}".split()
            w.pop(rng.randrange(len(w)))
            rng.shuffle(w)
        else:
            w = rng.sample(words, rng.randint(1, 18))
        rows.append((k, " ".join(w), rng.choice(["", None, "Yes."])))
    rows += [(900, None, None), (901, "", ""), (902, "same text", "here"), (903, "Here same", "TEXT"), (903, "Here same", "TEXT")]
    df = spark.createDataFrame([(*r, "x") for r in rows], "pair_id bigint, question string, answer string, sig string")
    want = jaccard_pairs([*dict((r[0], r) for r in rows).values()])
    for rare, block, share in ((128, 4096, 64), (2, 4, 64), (0, 4, 1), (0, 4096, 64)):
        monkeypatch.setattr(neardup, "RARE", rare)
        monkeypatch.setattr(neardup, "BLOCK", block)
        monkeypatch.setattr(neardup, "HOT_SHARE", share)
        assert {tuple(r) for r in neardup.near_pairs(df).collect()} == want
    monkeypatch.undo()
    groups = neardup.near_groups(df).collect()
    assert len(groups) == len({r[0] for r in rows}) and {r.pair_id: r.copies for r in groups}[902] == 2
    assert len({r.group for r in groups if r.pair_id in (902, 903)}) == 1


def test_similar_sets_share_keys():
    """Every pair of similar sets has a key in common at which it is compared, whichever words are rare."""
    np, rng = neardup.np, random.Random(3)
    for k in range(6000):
        n = rng.choice([rng.randint(4, 18), rng.randint(4, 90)])
        a = rng.sample(range(1, 1 << 32), n)
        drop = rng.randint(0, n // 9)
        b = a[drop:]
        add = 0
        while 5 * len(b) >= 4 * (n + add + 1) and add < n // 4:
            add += 1
        b = b + rng.sample(range(1, 1 << 32), rng.randint(0, add))
        level = np.full(1 << 10, 255, np.uint8)
        level[: rng.choice([0, 0, 100, 300, 900])] = 7
        if set(a) == set(b):
            continue
        sets = [np.array(sorted(x), np.uint32) for x in (a, b)]
        size = np.array([len(x) for x in sets])
        key, row, meets = neardup.keys_of(np.concatenate(sets), np.repeat([0, 1], size), size, level)
        one, two = (dict(zip(key[row == i].tolist(), meets[row == i].tolist())) for i in (0, 1))
        assert any(one[x] or two[x] for x in one.keys() & two.keys()), (a, b)


def test_near_pairs_empty(spark):
    df = spark.createDataFrame([], "pair_id bigint, question string, answer string")
    assert neardup.near_pairs(df).collect() == [] and neardup.near_groups(df).collect() == []


# --- p2


@pytest.mark.parametrize(
    "text, kinds",
    [
        (None, []), ("", []), ("plain * 3 * 4, a_b_c, C:\\temp\\new, 3 < x and y > 2, $5 to $7, R&D", []), ("[OCR Text: A] and === Document Text ===", []), ("- a\n- b\n1. c", []),
        ("a <b>c</b>", ["html"]), ("a &amp; b", ["html"]), ("<!-- x -->", ["html"]), ("if a <b and c> d", []), ("# T\n\ntext", ["markdown"]), ("see [x](y.md)", ["markdown"]), ("a **b** c", ["markdown"]),
        ("call __init__(x)", []), ("T\n====\n", ["markdown"]), ("| a | b |\n|---|---|\n| 1 | 2 |", ["markdown"]), ("== T ==\ntext", ["wiki"]), ("[[a|b]] c", ["wiki"]), ("''a'' b", ["wiki"]), ("{{x|y=1}}", ["wiki"]),
        ("\\section{T} x", ["latex"]), ("so $x_{1}$ is", ["latex"]), ("\\(a\\)", ["latex"]), ("{\\it a} b", ["latex"]), ("50\\% of it", ["latex"]), ("# limit 3\nif x:", []),
    ],
)
def test_markup_kinds(text, kinds):
    assert markup.markup_kinds(text) == kinds


def test_markup_clean(spark):
    assert markup.clean_text("<html><body><h2>T</h2><p>a &amp; <b>b</b></p><ul><li>x</li><li>y</li></ul><pre><code>p &lt; q</code></pre><table><tr><td>1</td><td>2</td></tr></table></body></html>") == "## T\n\na & b\n\n- x\n- y\n\n```\np < q\n```\n\n| 1 | 2 |"
    assert markup.clean_text("== T ==\n'''a''' [[b|c]]\n* x\n{|\n! h !! i\n|-\n| 1 || 2\n|}") == "# T\na c\n- x\n\n| h | i |\n| 1 | 2 |"
    assert markup.clean_text("\\section{T}\n\\textbf{a} \\cite{k} \\begin{itemize}\\item x\\end{itemize} $x^2$ and \\[y\\]") == "## T\n\na - x $x^2$ and $$y$$"
    assert markup.clean_text("T\n====\n\n> a **b** `c` [d](e)\n\n```\n*x*\n```") == "# T\n\na b c d\n\n```\n*x*\n```"
    assert markup.clean_text("nothing  at\nall") == "nothing  at\nall" and markup.clean_text(None) == ""
    rows = [(i, f"H/x{i}.html", f"Site menu\nAbout us\n<p>body {i} {'z' * i} and more text than the menu has</p>") for i in range(4)] + [(9, None, None), (10, "q", "")]
    got = {r.doc_id: r.clean for r in markup.clean_documents(spark.createDataFrame(rows, "doc_id bigint, source string, content string")).collect()}
    assert got[2] == "body 2 zz and more text than the menu has" and got[9] == "" and got[10] == ""
    assert markup.clean_documents(spark.createDataFrame([], "doc_id bigint, source string, content string")).count() == 0
    assert markup.kinds_of(spark.createDataFrame([(1, "<b>x</b>", "a"), (1, "<b>x</b>", "a"), (2, None, "b")], "doc_id bigint, content string, markup string")).collect() == [(1, "html")]


def test_template_tokens(spark):
    foot = "This footer is longer than the bound. " * 8
    page = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/a'>About us</a></li></ul></nav><h2>Topic {0}</h2><p>The text {0} of page {0} says much more than what stands around it in the footer, because pages are read for their text {0}{1}.</p><ul><li>Step one</li><li>Step {0}</li></ul><pre>return x - 1\nprint(total)</pre><table><tr><td>Sum</td><td>x{0}</td></tr></table><footer>Imprint and more</footer>"
    wiki = "[[Main page|Start]] | [[Help]]\n== Head {0} ==\n''Text'' {0} that goes on and on about {0} for a good while{1}\n{{|\n| Sum || y{0}\n|}}\n\nAll rights are reserved\n'''Imprint''' of the site"
    rows = [(i, "html/x", page.format(i, "z" * i)) for i in range(4)] + [(10 + i, "wiki/x", wiki.format(i, "z" * i)) for i in range(4)]
    rows += [(20 + i, "md/x", f"```\nif x:\n    return x - 1\n```\nText {i} of the page, which is longer than its menu\nif y:\nreturn y\nText {i}\nSite menu\nImprint\nHelp") for i in range(4)] + [(30 + i, "txt/x", f"Own {i}\nif x > {i}:\n{foot * i}{'Own text. ' * 90}{i}\n{foot}\nImprint\nHelp") for i in range(4)]
    rows += [(40 + i, "copies/x", f"Title of it\nOne text here\nTwo texts here\nThree texts here\nlast edit {i}") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, content string")
    got = {r.doc_id: r.clean for r in markup.clean_documents(docs).collect()}
    assert got[2] == "## Topic 2\n\nThe text 2 of page 2 says much more than what stands around it in the footer, because pages are read for their text 2zz.\n\n- Step one\n- Step 2\n\n```\nreturn x - 1\nprint(total)\n```\n\n| Sum | x2 |"
    assert got[12] == "# Head 2\nText 2 that goes on and on about 2 for a good whilezz\n\n| Sum | y2 |"
    assert got[22] == "```\nif x:\n    return x - 1\n```\nText 2 of the page, which is longer than its menu\nif y:\nreturn y\nText 2"
    assert "Own text" in got[32] and not got[32].endswith("Help") and got[42].startswith("Title of it") and got[42].endswith("last edit 2")
    found = markup.host_templates(docs).collect()
    assert {r.host for r in found} >= {"html", "wiki"} and all(r.tokens >= 3 and r.pages >= 3 for r in found)


def test_class_order():
    """Nested classes name the gap they lie in; overlapping and unordered ones are not regular."""
    def regular(*rows):
        return {c: (ok, parent, gap) for c, ok, _, parent, gap in markup.class_order(list(rows))}

    outer, inner = [(1, 10, [0]), (1, 11, [5]), (1, 12, [9])], [(2, 20, [1, 3]), (2, 21, [2, 4])]
    assert regular(*outer, *inner) == {1: (True, 0, 0), 2: (True, 1, 0)}
    assert regular(*outer, (2, 20, [1, 6]), (2, 21, [2, 7]))[2][0] is False
    assert regular((1, 10, [0]), (1, 11, [2]), (2, 20, [1]), (2, 21, [3])) == {1: (False, 0, 0), 2: (False, 1, 0)}
    assert regular((1, 10, [0, 3]), (1, 11, [1, 2]))[1][0] is False


def test_unbounded_marks():
    long = "x" * 900
    assert markup.markup_kinds(f"**{long}**") == ["markdown"] and markup.markup_kinds(f"$$a_1 + {long}$$") == ["latex"] and "wiki" in markup.markup_kinds("{{" + long + "}}")
    assert markup.clean_wiki("a {{x|{{y|{{z|{{q|1}}}}}}}} b {{c") == "a  b {{c" and markup.clean_latex("\\textbf{" * 6 + "deep" + "}" * 6) == "deep"


# --- p3


def test_canonical():
    one = "Course Texts/unit 2/pump-Übung.pdf"
    for other in ("course texts/UNIT 2/PUMP-ÜBUNG.PDF", " ./Course%20Texts/unit 2//pump-%C3%9Cbung.pdf\t", "file:///Course Texts/unit 2/./pump-U\u0308bung.pdf#page=3", "Course Texts\\x\\..\\unit 2\\pump-Übung.pdf#p2 ", "FILE:///COURSE TEXTS/UNIT 2/PUMP-ÜBUNG.PDF"):
        assert splits.canonical_path(other) == splits.canonical_path(one)
    for other in ("Course Texts/unit 3/pump-Übung.pdf", "Course Texts/unit 2/pump-Übung-v2.pdf", "Course Texts/unit 2/pump-Übung.txt", "unit 2/pump-Übung.pdf"):
        assert splits.canonical_path(other) != splits.canonical_path(one)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(120)] + [(7, 7), (5000, 5000)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in splits.connected_components(spark.createDataFrame(edges, "a bigint, b bigint").repartition(16)).collect()}
    assert got == {x: find(x) for x in parent}
    with pytest.raises(RuntimeError):
        splits.connected_components(spark.createDataFrame([(9 - i, 10 - i) for i in range(9)], "a bigint, b bigint").repartition(9), levels=0, max_rounds=0)


def test_greedy_bulk():
    classes, shares = [(50, 3), (7, 40), (1, 5000)], [0.8, 0.1, 0.1]
    total = sum(s * n for s, n in classes)
    missing = [s * total for s in shares]
    for size, n in classes:
        for _ in range(n):
            k = max(range(3), key=lambda k: (missing[k], -k))
            missing[k] -= size
    bulk = [s * total for s in shares]
    for size, counts in splits.greedy_counts(classes, shares):
        assert sum(counts) == dict(classes)[size]
        bulk = [m - size * c for m, c in zip(bulk, counts)]
    assert all(abs(a - b) <= 7 for a, b in zip(missing, bulk)) and all(abs(b) <= 1 for b in bulk)


def test_split_records(spark):
    rows = [(i, f"d/f{i % 50}.txt" if i % 2 else f"D/./f{i % 50}.TXT#p1") for i in range(600)] + [(i, "hot.pdf") for i in range(600, 900)] + [(i, None) for i in range(900, 1000)] + [(1, "d/f1.txt")]
    shares = spark.createDataFrame([("train", 0.6), ("test", 0.2), ("val", 0.2)], "split string, share double")
    got = splits.split_records(spark.createDataFrame(rows, "pair_id bigint, source string"), shares).collect()
    assert len(got) == 1000
    by_file = {}
    for r in got:
        by_file.setdefault(splits.canonical_path(r.source) if r.source else r.pair_id, set()).add(r.split)
    assert all(len(s) == 1 for s in by_file.values())
    for name, share in (("train", 0.6), ("test", 0.2), ("val", 0.2)):
        assert abs(sum(r.split == name for r in got) - 1000 * share) <= 2
    assert splits.split_records(spark.createDataFrame([], "pair_id bigint, source string"), shares).count() == 0
    pairs_ = splits.spelling_pairs(spark.createDataFrame([("a/B.txt",), ("A/b.txt",), ("a/B.txt",), (None,), ("",)], "source string")).collect()
    assert [tuple(r) for r in pairs_] == [("A/b.txt", "a/B.txt")]


# --- p4


@pytest.mark.parametrize(
    "q, a, i, d",
    [
        ("What is the pump?", None, None, "empty"), ("What is the pump?", " \u200b", None, "empty"), ("What is it?", "N/A", None, "empty"), ("What is it?", "[no answer]", "", "empty"), ("Is it so?", "No.", None, None), ("Is it so?", "Yes", None, None),
        ("Where is the pump in the hall?", "in the north hall", None, None), ("When was the pump bought?", "1992", None, None), ("Which parts?", "- casting\n- workbook", None, None),
        ("What is the pump for?", "The pump lifts the water. It was bui", None, "truncated"), ("What is the pump for?", "The pump lifts the water (see", None, "truncated"), ("Steps?", "1. Open the valve.\n2. Close the", None, "truncated"), ("What is the pump for?", "The pump lifts the wa...", None, "truncated"),
        ("What is the pump for?", "I'm sorry, but I can't help with that request.", None, "refusal"), ("What is the pump for?", "“I am sorry,” wrote Ann, “but I could not update the pump”; later she did.", None, None), ("Who?", "The pilots said that they cannot install the pump, so Ann did it.", None, None),
        ("Wozu dient die Pumpe?", "Leider fehlen mir dafür die Angaben. Bitte fragen Sie eine Fachkraft.", None, "refusal"), ("À quoi sert la pompe ?", "Désolé, il m'est impossible d'en dire plus.", None, "refusal"), ("Why?", "I cannot confirm the date, but the pump is in the hall.", None, None),
        ("How does the pump of Ann behave in the hall?", "HOW DOES THE PUMP OF ANN BEHAVE IN THE HALL", None, "copies_question"), ("How does the pump of Ann behave in the hall?", "How does the pump of Ann behave in the hall? It is loud and slow.", None, None),
        ("How does the pump behave in the hall?", "Die Pumpe ist in der Halle und wird nicht gebraucht.", None, "other_language"), ("How does the pump behave in the hall?", "Die Pumpe ist in der Halle und wird nicht gebraucht.", "Answer in German.", None), ("How does the pump behave?", "ポンプを点検してください。", None, "other_language"), (None, "A good answer.", None, None),
        ("水泵为什么没有检查？", "水泵为什么没有检查", None, "copies_question"), ("水泵为什么没有检查？", "水泵为什么没有检查？因为班长在地下室测量了过滤器。", None, None),
        ("How does the pump behave in the hall?", "La pompa della sala è molto vecchia e non viene più usata da nessuno.", None, "other_language"), ("How does the pump behave in the hall?", "De pomp van de hal is niet meer in gebruik en wordt verkocht.", None, "other_language"),
        ("¿Cómo se usa la bomba en la sala?", "La bomba de la sala no se usa para nada porque es muy vieja.", None, None), ("What is the pump for?", "It lifts (see the plan [2) and fills", None, "truncated"),
    ],
)
def test_defects(q, a, i, d):
    assert pairs.defect(q, a, i) == d


def test_suffix_automaton():
    rng = random.Random(2)
    for _ in range(100):
        x, y = ([rng.choice("abc") for _ in range(rng.randint(0, 12))] for _ in range(2))
        runs = pairs.SuffixAutomaton(x).matches(y)
        for i, n in enumerate(runs):
            longest = max((k for k in range(i + 2) if k == 0 or any(x[j : j + k] == y[i + 1 - k : i + 1] for j in range(len(x)))), default=0)
            assert n == longest


def test_defect_rows(spark):
    df = spark.createDataFrame([(1, "q", None, None, "d"), (1, "q", None, None, "d"), (2, None, None, None, "x")], "pair_id bigint, question string, answer string, instruction string, defect string")
    assert sorted(tuple(r) for r in pairs.defects(df).collect()) == [(1, "empty"), (2, "empty")]
    assert pairs.defects(df.limit(0)).collect() == []


# --- p5


def test_plan_bounds():
    rng = random.Random(4)
    for _ in range(150):
        text = "".join(rng.choice(["word ", "longerword", ". ", "\n", "\n\n", ", "]) for _ in range(rng.randint(0, 120)))
        limit, overlap = rng.randint(5, 60), rng.randint(0, 20)
        plan = pieces.cut_plan(len(text), pieces.boundaries(text), limit, overlap)
        overlap = min(overlap, limit - 1)
        assert plan[0][0] == 0 and plan[-1][1] == len(text) and all(b - a <= limit for a, b in plan)
        assert all(nxt[0] == this[1] - overlap for this, nxt in zip(plan, plan[1:]))


def test_planner_equals_whole():
    """Ranges of any size give the plan of the whole text, also across long blanks, quotes and runs at their seams."""
    rng = random.Random(12)
    for _ in range(1500):
        parts = ["word ", "x" * 30, ". ", "\n", "\n\n", ", ", "語。", "語", " " * 70, "\n \t\n", ".”) ", "。」）", "3.5", "!!", "\t" * 9, "-" * 80]
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 60)))
        limit, overlap, size = rng.randint(5, 80), rng.randint(0, 20), rng.randint(1, 90)
        planner, got = pieces.Planner(len(text), limit, overlap), []
        for off in range(0, len(text), size):
            body = text[off : off + size]
            a, b = pieces.seams(body)
            ends = [[off + a + e for e in found] for found in pieces.boundaries(body[a:b])] if b else [[] for _ in pieces.BOUNDARIES]
            got += planner.add(off, len(body), body[: a + 1], body[b - 1 :] if b else "", ends, pieces.longest_run(body, limit), pieces.RUN_HEAD.match(body).end(), pieces.tail_run(body))
        assert [g[1:] for g in got] == pieces.cut_plan(len(text), pieces.boundaries(text), limit, overlap), (text, limit, overlap, size)
        assert [g[0] for g in got] == list(range(len(got))) and planner.forced == pieces.longest_run(text, limit)


def test_ranges_equal_whole(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice(["word ", "x" * 30, ". ", "\n", "\n\n", ", ", "語。", " " * 150]) for _ in range(rng.randint(5, 150))) for _ in range(40)]
    rows = [(i, t, 50, 7, 0) for i, t in enumerate(texts)] + [(100, None, 50, 7, 0), (101, "", 50, 7, 0), (0, texts[0], 50, 7, 0)]
    df = spark.createDataFrame(rows, "doc_id bigint, content string, `limit` int, overlap int, off int")
    whole, parts = ({(r.doc_id, r.piece_no): (r.start_pos, r.end_pos, r.forced) for r in pieces.plans(df, range_chars=n).collect()} for n in (1 << 18, 97))
    assert whole == parts and (100, 0) not in whole and whole[101, 0] == (0, 0, False)
    for size in (1 << 18, 97):
        got = {}
        for r in pieces.pieces(df, range_chars=size).orderBy("doc_id", "piece_no").collect():
            assert r.piece == (texts[r.doc_id] if r.doc_id < 100 else "")[r.start_pos : r.end_pos]
            got.setdefault(r.doc_id, []).append(r.piece)
        assert set(got) == {*range(40), 101}
        assert all(p[0] + "".join(x[7:] for x in p[1:]) == texts[k] for k, p in got.items() if k < 100)


def test_limits(spark, monkeypatch):
    limits = spark.createDataFrame([("pdf", 10, 2), ("PDF ", 12, 2)], "format string, max_chars int, overlap_chars int")
    docs = spark.createDataFrame([(1, " PDF", "a" * 11, 3), (2, "pdf", "a b c d e f g", 3), (3, None, "a" * 30, 3), (4, "pdf", None, 3)], "doc_id bigint, format string, content string, `limit` int")
    assert sorted(tuple(r) for r in pieces.cut_kinds(pieces.limited(docs, limits)).collect()) == [(1, "forced"), (2, "natural")]
    monkeypatch.setattr(pieces, "MAX_FORMATS", 0)
    with pytest.raises(ValueError):
        pieces.limited(docs, limits)


@pytest.mark.parametrize("end", ["", "\n"])
def test_file_pieces(spark, tmp_path, end):
    text = "äöü word 語 \n" * 50 + "last one without a break" + end
    (tmp_path / "x.txt").write_text(text, encoding="utf-8")
    (tmp_path / "y.txt").write_text("short", encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200b")
    try:
        got = pieces.file_pieces(spark, str(tmp_path), 20, 5, 64).orderBy("piece_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    plan = pieces.cut_plan(len(text), pieces.boundaries(text), 20, 5)
    mine = [r for r in got if r.path.endswith("x.txt")]
    assert [(r.start_pos, r.end_pos) for r in mine] == plan and all(r.piece == text[r.start_pos : r.end_pos] for r in mine)
    assert [r.piece for r in got if r.path.endswith("y.txt")] == ["short"]


# --- p6


PAGE = "Report on Pumps{n}\n\nThe pump was checked by the crew in the north hall and the pre-\nssure was low. The budget of the hall was cut and the pump was sold.\n{m}"


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "2024-01-01 00:00:00", 1) for r in rows], "page_id bigint, doc_id bigint, page_no int, text string, scanned_at string, skip int")


def test_scans(spark):
    body = "The pressure of the pump in the hall was low and the budget was cut by the crew.\n" * 6
    rows = [(p, 1, p, PAGE.format(n="", m=f"- {p} -")) for p in (1, 2, 3)] + [(4, 2, 1, body), (5, 2, 2, body + "the 6udget of the hall was c|ear, a well-\nknown fact"), (6, 3, 1, ""), (7, 3, 2, None), (1, 1, 1, PAGE.format(n="", m="- 1 -"))]
    rows += [(8, 4, 1, "a well-known pump and a well-known hall\n" * 3)]
    df = pages_of(spark, rows)
    noise = scans.Noise(df)
    got = {tuple(r) for r in noise.found().collect()}
    for p in (1, 2, 3):
        assert {(p, 0, "header"), (p, 4, "page_no"), (p, 2, "hyphen")} <= got
    assert (5, 6, "misread") in got and not any(r[0] == 5 and r[2] == "hyphen" for r in got)
    text = {}
    for r in noise.paragraphs().orderBy("doc_id", "paragraph_no").collect():
        text[r.doc_id] = text.get(r.doc_id, "") + "\n\n" + r.text
    assert "the pressure was low" in text[1] and "Report" not in text[1] and "the budget of the hall" in text[2]
    none = scans.Noise(df.limit(0))
    assert none.found().collect() == [] and none.paragraphs().collect() == []


def test_scans_in_context(spark):
    """A misread word with two possible readings is corrected by its neighbours, differently at different places."""
    body = ("old engines fail without any oil in winter and that is known\n" + "yellow leaves fall from the tree in autumn and that is known\n") * 12
    df = pages_of(spark, [(1, 1, 1, body), (2, 2, 1, body + "old engines fa|l without any oil and yellow leaves fa|l from the tree in autumn")])
    noise = scans.Noise(df)
    assert {tuple(r) for r in noise.found().where("noise = 'misread'").collect()} == {(2, 24, "misread")}
    text = noise.paragraphs().where("doc_id = 2").collect()[-1].text
    assert text.endswith("old engines fail without any oil and yellow leaves fall from the tree in autumn")


def test_paragraphs_over_pages(spark):
    rows = [(p, 1, p, f"so page {p} goes on\nand stops within it" if p < 400 else "then it ends.\n\nA new one.") for p in (255, 256, 257, 400)] + [(p, 2, p, "All is said.") for p in (1, 2)]
    got = [(r.doc_id, r.paragraph_no, r.text) for r in scans.Noise(pages_of(spark, rows)).paragraphs().orderBy("doc_id", "paragraph_no").collect()]
    assert [g[:2] for g in got] == [(1, 0), (1, 1), (2, 0), (2, 1)] and got[1][2] == "A new one."
    assert got[0][2] == " ".join(f"so page {p} goes on and stops within it" for p in (255, 256, 257)) + " then it ends."


def test_two_line_headers(spark):
    rows = [(p, 1, p, f"Report on Pumps | {p}\nInternal Draft of the Board\n" + " ".join(f"word{p}x{k}" for k in range(9)) + " and the text goes\non here with more words in it\nand it ends.") for p in range(1, 5)]
    got = {tuple(r) for r in scans.Noise(pages_of(spark, rows)).found().where("noise = 'header'").collect()}
    assert got == {(p, i, "header") for p in range(1, 5) for i in (0, 1)}


def test_information():
    """The factors give back the information of words that meet, and none of words that don't."""
    n = scans.np.array([[0.0, 8.0], [8.0, 0.0]])
    assert scans.np.allclose(scans.information(n, n.sum(1)[:, None], n.sum(0)[None, :], n.sum()), [[0, scans.math.log(2)], [scans.math.log(2), 0]])


def test_edges():
    assert scans.edges("12\nA title\nbody text goes on and on\n- 13 -")[0] == [0, 3]
    assert scans.edges("") == ([], []) and scans.edges("only")[0] == []
    assert "modern" in scans.variants("modem") or "modern" not in scans.variants("modem")
    assert "modem" in scans.variants("modern") and "budget" in scans.variants("6udget") and "cellar" in scans.variants("ce|1ar")
    assert scans.variants("|" * 60 + "a") == [] and scans.token_of("l" * 65) == ""


# --- p7


@pytest.mark.parametrize(
    "text, kind",
    [
        ("The pump was checked by the crew. It is old.", "prose"), ("Short note", "list"), ("- a\n- b of it\n- c", "list"), ("One of the engineers noted that the pump is in the hall:\n1. pump\n2. hall\n3. crew\n4. valve", "list"),
        ("The crew checked all the pumps in the hall before the audit.\nIt was a long day and the valve was closed by hand.\n- pump\n- hall", "prose"), ("a | b | c\n1 | 2 | 3\n4 | | 6", "table"), ("a\tb\tc\n1\t2\t\n3\t\t4", "table"),
        ("vzzkks hbjzzwgl bqjgvknqa zgjflxkbwv gmgc bq zglzxwngvw", "junk"), ("firewall labels, " * 20, "junk"), ("§¤¤^0#0 ^x §¤}§^¦~}¤0x|%}¤0# ~#0;}0/%", "junk"), ("", "junk"), (" \n ", "junk"), ("x" * 5000, "junk"),
        ("Ann: The pump was checked by the crew in the hall.\nBob: It is old and the valve was closed by hand.", "prose"), ("请先检查阀门。水泵如果失效，应当早班之后批准仓库。", "prose"),
    ],
)
def test_verdict(text, kind):
    assert quality.LineModel().judge(text)[1] == kind


def test_quality_rows(spark):
    df = spark.createDataFrame([(1, "The pump is old.\nIt works.", 5), (2, None, 5), (3, "", 5), (1, "The pump is old.\nIt works.", 5)], "row_id bigint, text string, kind int")
    rows = quality.verdicts(df, ["row_id"]).collect()
    got = {r.row_id: r for r in rows}
    assert len(rows) == 2 and set(got) == {1, 3} and got[1].word_count == 6 and got[1].closed_line_share == 1 and abs(got[1].mean_word_length - 19 / 6) < 1e-9 and got[3].word_count == 0
    assert quality.verdicts(df.limit(0), ["row_id"]).collect() == []


def test_line_codes():
    rng = random.Random(3)
    for _ in range(100):
        parts = tuple(rng.randrange(b) for b in quality.BASES)
        assert quality.parts_of(quality.code_of(parts)) == parts == tuple(quality.PARTS[quality.code_of(parts)])


def test_training_counts_all_lines(spark):
    """Ten times the same texts give nearly the same model; what is seen often under a label becomes likelier there."""
    texts = ["- one thing\n- two things\n- three\n- four", "The pump of the hall was checked by the crew and it is old.\nIt was closed by hand in the hall."] * 60
    models = [quality.trained(quality.observed(spark.createDataFrame([(i, t) for i, t in enumerate(texts * n)], "row_id bigint, text string"), ["row_id"])) for n in (1, 10)]
    assert models[0].emissions[0][1][1] > quality.BELIEFS[0][1][1] and models[1].emissions[0][1][1] > quality.BELIEFS[0][1][1]
    assert all(abs(a - b).max() < 0.25 for a, b in zip(models[0].emissions, models[1].emissions)) and all(quality.np.allclose(e.sum(1), 1) for m in models for e in [*m.emissions, m.shares])


# --- p8


def edit_distance(p, t):
    row = [0] * (len(t) + 1)
    for i, c in enumerate(p):
        new = [i + 1]
        for j, d in enumerate(t):
            new.append(min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def test_myers():
    rng = random.Random(8)
    for _ in range(200):
        p, t = ("".join(rng.choice("abc") for _ in range(rng.randint(1, 70))) for _ in range(2))
        assert leaks.myers(p, t, 100)[0] == edit_distance(p, t)


def test_leaks(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    shared = "use only what the passage says and nothing more"
    items = spark.createDataFrame([(1, f"{shared} {item}"), (2, f"{shared} one two three"), (3, None), (4, "short")], "item_id bigint, text string")
    docs = [(1, "x ALPHA, béta-gamma\ndel-ta epsilon zeta eta theta y"), (2, "alpha beta gamma delta epsilon zeta eta"), (3, f"so {shared}."), (4, "alpha beta gamma delta epsilon zeta etta theta iota kapa"), (5, None), (6, ""), (7, "x ALPHA, béta-gamma\ndel-ta epsilon zeta eta theta y")]
    d = spark.createDataFrame([(*r, 0) for r in docs], "doc_id bigint, text string, item_id int")
    assert sorted(tuple(r) for r in leaks.leaked(d, items).collect()) == [(1, 1), (7, 1)]
    near = {(r.doc_id, r.edits) for r in leaks.find_leaks(d, items).collect()}
    assert {(1, 0), (4, 1), (7, 0)} <= near
    assert leaks.leaked(d.limit(0), items).collect() == [] and leaks.leaked(d, items.limit(0)).collect() == []


@pytest.mark.parametrize("errors", [1, 2, 3])
def test_edits_found(errors):
    """Passages with as many edits as the budget allows are all found, and none with more."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(14)]
    m = leaks.Matcher([(1, " ".join(words), [])], errors)
    for _ in range(300):
        k, n = rng.randrange(7), rng.randint(0, errors + 2)
        s = "".join(words[k : k + 8])
        for _ in range(n):
            at = rng.randrange(len(s))
            s = rng.choice([s[:at] + "z" + s[at + 1 :], s[:at] + s[at + 1 :], s[:at] + "z" + s[at:]])
        text = "qq" + s + "qq"
        least = min(edit_distance(p, text) for p in m.passages.values())
        assert m.find(text).get(1, (None,))[0] == (least if least <= errors else None)


def test_leaks_fold_and_blocks(spark, monkeypatch):
    """Letters of other scripts count whatever the items are; blocks of items give what all at once give."""
    base = "alpha beta gamma delta epsilon zeta eta theta"
    items = [(1, base), (2, "one two three four five six seven eight nine"), (3, "x one two three four five six seven eight"), (4, "uno dos tres cuatro cinco seis siete ocho")]
    docs = spark.createDataFrame([(1, "alpha beta gamma delta слово epsilon zeta eta theta"), (2, base.upper()), (3, "one two three four five six seven eight"), (4, "two three four five six seven eight nine"), (5, "UNO dós tres cuatro cinco seis siete ocho")], "doc_id bigint, text string")
    for extra in ([], [(5, "раз два три четыре пять шесть семь восемь")]):
        for most in (200_000, 1):
            monkeypatch.setattr(leaks, "MAX_ITEMS", most)
            got = sorted(tuple(r) for r in leaks.leaked(docs, spark.createDataFrame(items + extra, "item_id bigint, text string")).collect())
            assert got == [(2, 1), (4, 2), (5, 4)]


# --- p10


@pytest.mark.parametrize(
    "text, units",
    [
        ("", []), ("One. Two.", ["One.", "Two."]), ("Dr. Lom met M. Mar at 3 p.m. and left. He ran.", ["Dr. Lom met M. Mar at 3 p.m. and left.", "He ran."]), ('He said "Stop. Wait," and left. So did I.', ['He said "Stop. Wait," and left.', "So did I."]),
        ("It is 4.5 m. (It was 3.) Next one.", ["It is 4.5 m.", "(It was 3.)", "Next one."]), ("A title\nThe text starts here and ends.", ["A title", "The text starts here and ends."]), ("- one\n- two.\n\nEnd.", ["- one", "- two.", "End."]),
        ("The pump of the crew was checked by the long-term\nteam in the hall and it was found to be in very good\norder. Next one.", ["The pump of the crew was checked by the long-term\nteam in the hall and it was found to be in very good\norder.", "Next one."]),
        ("“请先检查。”班长说。为什么？", ["“请先检查。”班长说。", "为什么？"]), ("「止。」と言った。番号。", ["「止。」と言った。", "番号。"]), ("यह है। वह है?", ["यह है।", "वह है?"]), ("พบรายการ พนักงานวัด", ["พบรายการ", "พนักงานวัด"]), ("هل تم؟ قال د. Nes إن السجل.", ["هل تم؟", "قال د. Nes إن السجل."]),
        ("[OCR Text: A. B]\nEnd.", ["[OCR Text: A. B]", "End."]), ("Am 3. Tag kam er. Gut.", ["Am 3. Tag kam er.", "Gut."]), ("He ran.She sat.", ["He ran.", "She sat."]), ("EE. UU. no aparece. Fin.", ["EE. UU. no aparece.", "Fin."]), ("pH rose. pH values fell.", ["pH rose.", "pH values fell."]),
    ],
)
def test_sentences(text, units):
    assert [text[a:b] for a, b in sentences.Splitter().units(text)] == units


def test_sentences_partition():
    rng = random.Random(11)
    for _ in range(300):
        text = "".join(rng.choice(["Aa", "b", ". ", "! ", "\n", "\n\n", '"', "(", ")", "。", "“", "”", " ", "3", "- ", "[x]\n"]) for _ in range(rng.randint(0, 40)))
        at = 0
        for a, b in sentences.Splitter().units(text):
            assert a >= at and not text[at:a].strip() and text[a:b] == text[a:b].strip() != ""
            at = b
        assert not text[at:].strip()


def test_sentence_rows(spark):
    df = spark.createDataFrame([(1, "One. Two.", "en", 3), (2, None, None, 3), (3, "", "de", 3)], "doc_id bigint, text string, lang string, start_pos int")
    assert [tuple(r) for r in sentences.sentence_units(df).orderBy("start_pos").collect()] == [(1, 0, 4), (1, 5, 9)]
    assert sentences.sentence_units(df.limit(0)).collect() == []


def test_long_empty_and_refusing_answers():
    assert pairs.defect("What is it?", " \n" * 30, None) == "empty" and pairs.defect("What is it?", "- " * 30, None) == "empty"
    long = "I'm sorry. I cannot answer this question. " + "I do not have the information about this topic. " * 12 + "Please consult a qualified person."
    assert pairs.defect("Which valve opens first?", long, None) == "refusal"
    assert pairs.defect("Which valve opens first?", long + " The upper valve opens first.", None) is None


def test_sentences_behind_the_beginning():
    s = sentences.Splitter()
    head = "A heading in Latin letters. " * 12
    text = head + "สวัสดีครับ ผมชื่อสมชาย"
    assert [text[a:b] for a, b in s.units(text)][-2:] == ["สวัสดีครับ", "ผมชื่อสมชาย"]
    text = head + "The phrase สวัสดี ครับ is a greeting in Thai."
    assert [text[a:b] for a, b in s.units(text)][-1] == "The phrase สวัสดี ครับ is a greeting in Thai."
    text = "The Xyz. Before it was. " * 60 + "Here xyz Xyz. goes on."
    assert [text[a:b] for a, b in s.units(text)][0] != "The Xyz."


def test_sentences_evidence():
    s = sentences.Splitter()
    units = lambda text, s=s: [text[a:b] for a, b in s.units(text)]
    long = "“" + "It goes on and on. " * 200 + "” he said."
    assert units(long) == [long] and units('He said "go on. Then he left. She stayed.') == ['He said "go on.', "Then he left.", "She stayed."]
    assert units("They had no pump. I said no. Then we left.") == ["They had no pump.", "I said no.", "Then we left."] and units("See no. 5 or No. Seven.") == ["See no. 5 or No. Seven."]
    named = sentences.Splitter(frozenset(), frozenset({"May"}))
    assert units("It met J. May today. They saw that May was here.", named) == ["It met J. May today.", "They saw that May was here."]
