import json



from inkwell.operators import nested


def records(spark, *payloads):
    rows = [(i, p if p is None or isinstance(p, str) else json.dumps(p), "x") for i, p in enumerate(payloads, 1)]
    return spark.createDataFrame(rows, "record_id bigint, payload string, val string")


def name(surname, given=None):
    return {"surname": surname, "given-names": given}


def test_shapes_and_order(spark, rows_of):
    one = {"back": {"ref-list": {"ref": {"element-citation": {"article-title": {"content": ["On ", {"italic": "the"}, "  sea "]}, "person-group": {"@person-group-type": "author", "name": name("Bell", "A")}, "pub-id": {"@pub-id-type": "doi", "#text": "doi:10.1/x"}}}}}}
    two = {"article": {"back": [{"ref-list": {"ref": [{"label": 1}, {"mixed-citation": [{"article-title": "T1"}, {"article-title": {"#text": None}, "ext-link": {"@ext-link-type": "doi", "@xlink:href": "https://doi.example/10.2/y"}}]}], "ref-list": {"ref": {"citation-alternatives": {"mixed-citation": {"article-title": "loose"}, "element-citation": {"article-title": "firm"}}}}}}]}}
    three = {"ref-list": [{"ref": {"element-citation": {"person-group": [{"@person-group-type": "editor", "name": name("Ed")}, {"@person-group-type": "author", "member": [{"name": name({"#text": "Ray"})}, {"collab": "The Group"}, {"name": name("Ito", "B")}], "name": []}]}}}, None, {"ref": []}]}
    got = rows_of(nested.citation_values(records(spark, one, two, three)))
    assert got == [
        (1, 1, 1, "author", 1, "Bell A"), (1, 1, 1, "doi", 1, "10.1/x"), (1, 1, 1, "title", 1, "On the sea"),
        (2, 2, 1, "title", 1, "T1"), (2, 2, 2, "doi", 1, "10.2/y"), (2, 3, 1, "title", 1, "firm"),
        (3, 1, 1, "author", 1, "Ray"), (3, 1, 1, "author", 2, "The Group"), (3, 1, 1, "author", 3, "Ito B"),
    ]


def test_invalid_and_empty(spark):
    bad = [None, "", "{", '{"a": NaN}', "[]", "3", '"x"', {"back": None}, "[" * 100_000, {"ref-list": {"ref": {"element-citation": {"article-title": "\ud800"}}}}]
    out = nested.citation_values(records(spark, *bad))
    assert out.filter("record_id < 10").count() == 0
    assert out.count() == 1
    assert nested.citation_values(records(spark, {}).filter("false")).count() == 0


def test_repeated_rows_and_links(spark, rows_of):
    payload = {"ref-list": {"ref": {"element-citation": {"article-title": "T", "year": 1999}}}}
    df = records(spark, payload)
    assert nested.citation_values(df.union(df)).count() == 1
    assert rows_of(nested.citation_table(df)) == [(1, 1, 1, "T", None, None, "1999")]


def test_three_tables(spark, rows_of):
    meta = {"front": {"article-meta": {"article-id": [{"@pub-id-type": "pmc", "#text": "PMC1"}, {"@pub-id-type": "doi", "#text": "10.9/z"}], "title-group": {"article-title": {"content": ["A ", {"i": "b"}]}}}}}
    cited = {"element-citation": [{"article-title": "T", "person-group": {"name": [name("Bell", "A"), name(None), name("Ito")]}}, {}]}
    df = records(spark, {**meta, "back": {"ref-list": [{"ref": [{"label": 1}, cited]}, {"ref": cited}]}}, {"back": {}}, "{")
    both = df.union(df)
    assert rows_of(nested.article_table(both)) == [(1, "PMC1", "10.9/z", "A b", None, 3), (2, None, None, None, None, 0)]
    assert rows_of(nested.citation_table(both).select("record_id", "ref_pos", "cite_pos", "title")) == [(1, 2, 1, "T"), (1, 2, 2, None), (1, 3, 1, "T"), (1, 3, 2, None)]
    assert rows_of(nested.author_table(both)) == [(1, r, 1, a, n) for r in (2, 3) for a, n in ((1, "Bell A"), (2, None), (3, "Ito"))]
    assert rows_of(nested.invalid_records(df, "record_id", "payload")) == [(3, "invalid")]


def test_depth_has_no_limit(spark, rows_of):
    """Records deeper than any recursion goes are read, in lists, objects, texts and groups of authors."""
    n = 30_000
    title = "[" * n + '"deep"' + "]" * n
    text = '{"b":' * n + '"er"' + "}" * n
    people = '{"member":' * n + '{"name":{"surname":"Ray"}}' + "}" * n
    payload = '{"a":' * n + f'{{"ref-list":{{"ref":{{"element-citation":{{"article-title":{title},"source":{text},"person-group":{people}}}}}}}}}' + "}" * n
    df = records(spark, payload, payload[:-1], payload + "}", "[" * n + "]" * (n - 1) + "}")
    assert rows_of(nested.citation_values(df)) == [(1, 1, 1, "author", 1, "Ray"), (1, 1, 1, "title", 1, "deep")]
    assert rows_of(nested.citation_table(df).select("record_id", "source")) == [(1, "er")]
    assert nested.invalid_records(df, "record_id", "payload").count() == 3


def test_stack_reader_agrees_with_json():
    import random

    rng = random.Random(5)

    def made(depth):
        kind = rng.randint(0, 7 if depth < 5 else 5)
        if kind == 6:
            return [made(depth + 1) for _ in range(rng.randint(0, 3))]
        if kind == 7:
            return {rng.choice(["a", "b", "\u00e9\n", ""]): made(depth + 1) for _ in range(rng.randint(0, 3))}
        return rng.choice([None, True, False, 0, -12, 3.5, 1e300, -0.25, "x", "", 'q"\\/', "\ud83d\ude00"])

    for _ in range(300):
        value = made(0)
        text = json.dumps(value, indent=rng.choice([None, 1]), ensure_ascii=rng.random() < 0.5)
        assert nested.loads_deep(text) == json.loads(text)
        broken = text[: rng.randint(0, len(text))] + rng.choice(["", ",", "}", "]", ":", "1", '"', "nul"]) + text[rng.randint(0, len(text)) :]
        try:
            want = json.loads(broken)
        except ValueError:
            want = ValueError
        try:
            got = nested.loads_deep(broken)
        except ValueError:
            got = ValueError
        assert got == want, broken


def test_levels():
    entries = nested.dissect({"ref-list": {"ref": [{"element-citation": []}, {"element-citation": [{}, {"article-title": "x"}]}]}}, nested.CITATIONS)
    titles = [(rep, depth, value) for column, rep, depth, value in entries if column == "reference.citation.title"]
    # A missing citation keeps its place; the second of a reference repeats at its own level.
    assert titles == [(0, 1, None), (1, 2, None), (2, 2, "x")]
    assert [c for c, *_ in nested.dissect({}, nested.CITATIONS)] == list(nested.CITATIONS.columns())


def test_deep_record_is_no_crash():
    deep = {"a": {}}
    at = deep["a"]
    for _ in range(500):
        at["a"] = {}
        at = at["a"]
    at["ref-list"] = {"ref": {"element-citation": {"article-title": "deep"}}}
    assert any(v == "deep" for *_, v in nested.dissect(deep, nested.CITATIONS))
