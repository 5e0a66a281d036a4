import random

from weftline.functions.text import letters_only
from weftline.llm import boilerplate, sentences, site_lines

DOCS = "doc_id string, title string, body string, url string, source string, path string, line_no int"


def cuts(line):
    starts = sentences.line_starts(line)
    return [line[a:b].strip() for a, b in zip(starts, starts[1:] + [len(line)])]


def test_sentences():
    cases = [
        ["The U.K. loan vs. the grant, e.g. one, drew 4 letters.", "It reopens at 6.30 p.m. on Friday.", "eMuse lists 3.5 items."],
        ['Brunth asked, "Will it last?"', "The U.S. did."],
        ['Brunth said, "We keep it. Then we open it." and left.', "No. 46 is here (see p. 3).", "Dr. Doe agreed!"],
        ["Am 5. März öffnet Archiv, z. B. mit Bestand.", "Prof. Dr. Maskarby nannte es usw., blieb aber.", "Rund 4,2 Mio. Euro fließen."],
        ["« Gardons. Ouvrons. », a lancé M. Velarby.", "L'art. 3 vise, cf. p. 7, ceci ?", "Oui."],
        ["「守りたい。次は酒蔵だ。」と語った。", "議会は案（甲を含む。乙は除く。）を可決した．", "足りるだろうか!?", "Ver. 2.5の指針……それは延長だ。"],
        ["负责人说：“先做。再做。”随后离场。", "《基金。卷》收录5件！", "还能坚持多久？"],
        ["제5차 회의가 끝났다.", "자료 No. 46이 공개됐다.", "담당자는 “지키자. 그다음이다.”라고 했다."],
        ["डॉ. Doe ने 12.2 करोड़ माँगे।", "“बचाइए। खोलिए।” ऐसा Doe ने कहा।", "क्या?"],
        ["قال د. Doe: «نحفظ. ثم نفتح.» ثم غادر.", "هل يكفي؟", "وصل 5!"],
    ]
    for parts in cases:
        for joint in (" ", "  ", "　"):
            assert cuts(joint.join(parts)) == parts
    assert cuts("ห้องสมุดจะย้ายไปยัง Tomo ในปีหน้า งบประมาณเพิ่มขึ้น 12.5 ล้านบาท เพื่อเทศกาล") == ["ห้องสมุดจะย้ายไปยัง Tomo ในปีหน้า", "งบประมาณเพิ่มขึ้น 12.5 ล้านบาท เพื่อเทศกาล"]
    assert cuts("   ") == [] and cuts("人気の記事 2. 第5回会議") == ["人気の記事 2. 第5回会議"]
    assert cuts('unclosed "quote here. Next one starts.') == ['unclosed "quote here.', "Next one starts."]


def test_sentence_spans_are_whole(spark):
    text = "一つ。 二つ！\r\n\r\n Three. Four"
    spans = sentences.sentence_spans(text)
    assert [text[a:b] for _, _, a, b, _ in spans] == ["一つ。", "二つ！", "Three.", "Four"]
    assert [f for *_, f in spans] == [True, False, True, False] and sentences.sentence_spans(None) == []
    assert len(sentences.sentence_spans("One two. " * 50_000)) == 50_000


def test_found_starts(spark, listed):
    docs = spark.createDataFrame([("d", "t", "One two. Three.", "u", "s", "p", 1), ("d", "t", "One two. Three.", "u", "s", "q", 1), ("e", None, None, None, None, None, None), ("f", "", "", "", "", "", 0)], DOCS)
    baskets = spark.createDataFrame([(5, "甲。乙。丙", "x"), (6, None, None)], "basket_id bigint, text string, field string")
    assert listed(sentences.inner_starts(docs, baskets)) == [("basket_text", "5", 2), ("basket_text", "5", 4), ("doc_body", "d", 9)]
    assert sentences.inner_starts(docs.limit(0), baskets.limit(0)).count() == 0


def brute_lines(rows):

    docs = {}
    for doc, _, body, _, source, path, _ in sorted(rows, key=lambda r: (r[5] is None, r[5] or "")):
        if doc is not None and source is not None:
            docs.setdefault(doc, (source, body))
    size, held = {}, {}
    for doc, (source, body) in docs.items():
        size[source] = size.get(source, 0) + 1
        for line in (body or "").split("\n"):
            if letters_only(line):
                held.setdefault((source, letters_only(line)), set()).add(doc)
    return {(doc, i) for doc, (source, body) in docs.items() for i, line in enumerate((body or "").split("\n"), 1) if letters_only(line) and len(held[source, letters_only(line)]) >= max(3, 0.15 * size[source])}


def line_sample():
    rng = random.Random(2)
    shared = ["Menu | Home", "ＭＥＮＵ － home!", "© 2026 Site", "Sign up", "12 34", ""]
    rows = []
    for i in range(80):
        lines = [rng.choice(shared) for _ in range(rng.randrange(0, 5))] + [f"Own {chr(97 + i % 26)}{chr(97 + i // 26)} line"] + rng.choices(["Note alpha", "Note beta", "Note gamma"], k=1) + ["Home", "Foot"] * (i % 4 == 0)
        rows.append((f"d{i}", "t", "\n".join(lines), "u", "hot" if i % 3 else "small", f"p{i}", 1))
    return rows + rows[:5] + [("n", None, None, None, "hot", None, None), (None, "", "Menu home", "", "hot", "z", 0), ("q", "", "Menu home", "", None, "z", 0), ("e", "", "", "", "hot", "", 0)]


def test_repeated_lines_match_brute_force(spark):
    rows = line_sample()
    found = {tuple(r) for r in site_lines.repeated_lines(spark.createDataFrame(rows, DOCS)).collect()}
    assert found == brute_lines(rows) and found
    assert site_lines.repeated_lines(spark.createDataFrame([], DOCS)).count() == 0


def brute_blocks(rows):
    """(source, n_lines, docs) of each occurrence of a longest block that none a line earlier covers."""
    docs = {r[0]: (r[4], [letters_only(x) for x in (r[2] or "").split("\n") if letters_only(x)]) for r in sorted(rows, key=lambda r: str(r[5]), reverse=True) if r[0] and r[4]}
    size, held, out = {}, {}, []
    for doc, (source, keys) in docs.items():
        size[source] = size.get(source, 0) + 1
        for i in range(len(keys)):
            for n in range(1, len(keys) - i + 1):
                held.setdefault((source, *keys[i : i + n]), set()).add(doc)
    enough = lambda source, block: len(held[source, *block]) >= max(3, 0.15 * size[source])
    for source, keys in docs.values():
        last = 0
        for i in range(len(keys)):
            n = max([n for n in range(1, len(keys) - i + 1) if enough(source, keys[i : i + n])], default=0)
            if n and i + n > last:
                out.append((source, n, len(held[source, *keys[i : i + n]])))
            last = i + n if n else 0
    return sorted(out)


def test_blocks_of_several_lines(spark):
    long = [f"line {chr(97 + i)}" for i in range(23)]
    rows = [(f"d{i}", "", "\n".join([f"start {chr(97 + i)}", *long[i % 3 :], f"end {chr(97 + i)}", *long[:7]]), "", "s", f"p{i}", 1) for i in range(12)]
    rng = random.Random(8)
    mixed = [(f"m{i}", "", "\n".join("stem " + "".join(rng.choices("pq", k=1)) if rng.random() < 0.8 else f"own {i} " + rng.choice("xyz") for _ in range(rng.randrange(4, 14))), "", "s", f"p{i}", 1) for i in range(40)]
    for table in (rows, mixed, line_sample()):
        docs = spark.createDataFrame(table, DOCS)
        one = site_lines.distinct_docs(docs)
        blocks = site_lines.repeated_blocks(one, site_lines.line_keys(one)).collect()
        assert sorted((b.source, b.n_lines, b.docs) for b in blocks) == brute_blocks(table)
    docs = spark.createDataFrame(rows, DOCS)
    assert {(r.n_lines, r.docs) for r in site_lines.block_sizes(docs).collect()} >= {(21, 12), (23, 4), (22, 8)}
    clean = {r.doc_id: r.body for r in site_lines.without_repeated_lines(docs).collect()}
    assert clean["d0"] == "start a\nend a"


def test_furniture_by_consensus(spark):
    rng = random.Random(7)
    words = [f"{a}{b}" for a in "kstnm" for b in ("ari", "ova", "ule", "ith", "ond")]
    docs, want = [], set()
    for i in range(60):
        lines, page = [], []
        for kind in ("menu", "text", "text", "teaser", "text", "head", "foot"):
            if kind == "text":
                lines.append(f"The {rng.choice(words)} {rng.choice(words)} met {rng.choice(words)} in {rng.choice(words)}.")
                page.append(False)
            elif kind == "head" and i % 30 == 0:
                lines.append("Background")
                page.append(False)
            elif kind != "head" and rng.random() < 0.6:
                lines.append({"menu": "Home | News | Sign in", "teaser": f"Read next: {rng.choice(words)} and {rng.choice(words)} open", "foot": f"(c) {2000 + i} Daily Page, all rights reserved"}[kind])
                page.append(True)
        docs.append((f"d{i}", "t", "\n".join(lines), "u", "s", f"p{i}", 1))
        want |= {("doc_body", f"d{i}", n) for n, p in enumerate(page, 1) if p}
    items = spark.createDataFrame([(1, "s", None, "u"), (2, "s", "Home | News | Sign in\n\nWords of one story only.", "u"), (3, None, "", None)], "item_id bigint, source_id string, body string, url string")
    src = spark.createDataFrame([("s", "Daily Page")], "id string, name string")
    found = {tuple(r) for r in boilerplate.page_furniture(spark.createDataFrame(docs, DOCS), items, src).collect()}
    assert found == want | {("item_body", "2", 1)}
    assert boilerplate.page_furniture(spark.createDataFrame([], DOCS), items.limit(0), src.limit(0)).count() == 0


def test_sentences_without_a_blank_between():
    parts = ["It is a model.", 'Maskumber asked, "Will it last?"', "Is it safe with 86 staff?", "The U.K. loan drew 2 letters (see p. 6).", "Kell & Co. did."]
    assert cuts("".join(parts)) == parts
    assert cuts("足りるだろうか!?ICT公開を組み込む。") == ["足りるだろうか!?", "ICT公開を組み込む。"]
    assert cuts("https://a.example/x?Id=3 and St.Orvel") == ["https://a.example/x?Id=3 and St.Orvel"]


def test_quotations_are_no_menus(spark):
    quoted = "« Gardons musée. Ouvrons réserve. », a lancé Quisander de {} et Mme Ulvering attend 3 visiteurs pour le catalogue"
    own = [quoted.format("Mio"), "The grant covers prints and/or maps", "He said a > b. Then the board of the town left it at that, with no end"]
    docs = [(f"d{i}", "t", f"Menu {i} | Search\nSend/Print\nHome > News > Town {chr(97 + i)} opens a hall of many rooms for all the people\n{quoted.format(chr(97 + i))}\nOnly at s", "u", "s", f"p{i}", 1) for i in range(20)]
    docs += [("e", "t", "\n".join([*own, "Send/Print", "Only at s"]), "u", "t", "q", 1)]
    docs += [(f"r{i}", "t", "Send/Print\nThe words of a story, each its own " + chr(97 + i), "u", "r", f"r{i}", 1) for i in range(12)]
    empty = spark.createDataFrame([], "item_id bigint, source_id string, body string, url string")
    src = spark.createDataFrame([], "id string, name string")
    found = {tuple(r)[1:] for r in boilerplate.page_furniture(spark.createDataFrame(docs, DOCS), empty, src).collect()}
    assert found == {(f"d{i}", n) for i in range(20) for n in (1, 2, 3, 5)} | {(f"r{i}", 1) for i in range(12)} | {("e", 4)}  # one host's vote settles nothing elsewhere


def test_list_levels():
    text = "Intro text.\n1. First item. It goes on.\n   a) inner one\n   b) inner two\n      more of it\n2. Second item\n- flat\n(1) other kind\n(2) goes on\n- flat again\nText that ends all."
    levels = [(line, level) for line, level, *_ in sentences.sentence_spans(text)]
    assert levels == [(1, 0), (2, 1), (2, 1), (3, 2), (4, 2), (5, 2), (6, 1), (7, 2), (8, 3), (9, 3), (10, 2), (11, 0)]
    assert [level for _, level, *_ in sentences.sentence_spans("一、序論\n（1）細目\n（2）細目\n二、本論\n文。")] == [1, 2, 2, 1, 0]


def test_long_lines_take_linear_time():
    import time

    for line in ("(" * 60_000 + ")" * 60_000, '("' * 60_000, "„x“ (y) " * 40_000, "1. 2. 3. " * 40_000, "Am 5. März kam er. " * 20_000, "「あ。」と言う。" * 30_000, "(a.) b. " * 40_000):
        began = time.time()
        sentences.sentence_spans(line)
        assert time.time() - began < 6, line[:9]


def test_open_marks_match_a_search_through_the_stack():
    rng = random.Random(3)
    for _ in range(2000):
        line = "".join(rng.choices("()[]「」“”„\"'’a", k=rng.randrange(0, 30)))
        marks = [i for i, ch in enumerate(line) if ch in sentences.PAIRS or ch in sentences._CLOSE or ch == '"']
        stack, want = [], {}
        for at in marks:
            ch = line[at]
            if ch == "’" and 0 < at < len(line) - 1 and line[at + 1].isalpha() and line[at - 1].isalpha():
                continue
            kinds = ['"'] if ch == '"' else sentences._CLOSE.get(ch, [])
            k = next((k for k in range(len(stack) - 1, -1, -1) if line[stack[k]] in kinds), None)
            if k is not None:
                want[stack[k]] = at
                del stack[k:]
            elif ch == '"' or ch in sentences.PAIRS:
                stack.append(at)
        assert sentences._matches(line, marks) == want
