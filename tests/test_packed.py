import itertools
import random

from inkwell.operators import packed

PEOPLE = [("Bell", "AB", "Anna"), ("Ray", "C", "Carl"), ("de Ito", "DEF", "Dora"), ("Orr-Poe", "G", "Gus"), ("O'Hale", "HJ", "Hal"), ("McLin", "K", "Kim"), ("van der Moo", "LN", "Lea")]


def dotted(initials, gap=""):
    return gap.join(f"{i}." for i in initials)


def styles(people):
    """``(field, values)`` of some people in every style."""
    short = [f"{s} {i}" for s, i, _ in people]
    comma = [f"{s}, {dotted(i)}" for s, i, _ in people]
    wide = [f"{s}, {dotted(i, ' ')}" for s, i, _ in people]
    before = [f"{dotted(i, ' ')} {s}" for s, i, _ in people]
    full = [f"{g} {s}" for s, _, g in people]
    yield ", ".join(short), short
    yield f" {', '.join(short)}\n", short
    yield ",\n      ".join(short), short
    yield ", ".join(short) + " et al.", short
    yield ", ".join(short) + ", et al", short
    yield "; " + "; ".join(short) + ";; ", short
    yield "\n".join(short), short
    for mark in ("; ", ";", " ; "):
        yield mark.join(comma), comma
        yield mark.join(wide) + ";", wide
    yield ", ".join(comma), comma
    yield ", ".join(wide), wide
    if len(people) > 1:
        yield ", ".join(wide[:-1]) + f", & {wide[-1]}", wide
        yield ", ".join(comma[:-1]) + f", and {comma[-1]}", comma
        yield ", ".join(short[:-1]) + f" and {short[-1]}", short
        yield ", ".join(short[:-1]) + f" AND {short[-1]}", short
        yield ",\n    ".join(wide[:-1]).replace(", ", ",\n    ") + f",\n    & {wide[-1]}", wide
    for mark in (" | ", "|", " / ", "\t", " • ", "；", "、"):
        yield mark.join(full), full
        yield mark.join(before), before
    for mark in (", ", ",", " ", ";"):
        yield mark.join(f'"{c}"' for c in comma), comma
    group = "Centre of Soil, Water; and Health"
    yield ", ".join(short) + f', "{group}"', [*short, group]
    yield f'"{group}", ' + ", ".join(short), [group, *short]
    if len(people) > 2:
        marks = [" | ", ", ", "; ", " and ", ","]
        mixed = short[0] + "".join(m + s for m, s in zip(itertools.cycle(marks), short[1:]))
        yield mixed, short
    nick = f'{people[0][0]}, "Ace" {dotted(people[0][1])}'
    yield '"' + nick.replace('"', '""') + '"' + "".join(f', "{c}"' for c in comma[1:]), [nick, *comma[1:]]


def test_every_style(spark, rows_of):
    rng = random.Random(5)
    cases = [case for n in range(1, 7) for _ in range(4) for case in styles(rng.sample(PEOPLE, n))]
    rows = [(i, field, "clash", 9) for i, (field, _) in enumerate(cases)]
    rows += [(-1, None, "v", 1), (-2, "", "v", 1), (-3, "  ", "v", 1), (-4, " ; ", "v", 1)]
    df = spark.createDataFrame(rows, "k bigint, authors string, author string, pos int")
    got: dict[int, list[str]] = {}
    for key, pos, value in rows_of(packed.split_packed(df, "k", "authors", "author")):
        got.setdefault(key, []).append(value)
        assert pos == len(got[key])
    assert min(got) == 0
    wrong = [(field, got.get(i)) for i, (field, values) in enumerate(cases) if got.get(i) != values]
    assert len(wrong) <= 0.01 * len(cases), wrong[:5]


def test_surnames_only_and_suffixes():
    either = packed.Dialect(";,", False, True, "either")
    assert packed.parse("de Bell, L.B., Jr.; Ray, C.", either) == ["de Bell, L.B., Jr.", "Ray, C."]
    assert packed.parse("Bell, Ray and Ito", either) == ["Bell", "Ray", "Ito"]
    assert packed.parse(" , ;; et al.", either) == []


def test_repeats_ties_and_empty(spark):
    df = spark.createDataFrame([(1, "Bell A, Ray C"), (1, "Bell A, Ray C"), (2, "Bell A, Ray C")], "k bigint, a string")
    assert packed.split_packed(df, "k", "a").count() == 4
    assert packed.split_packed(df.filter("false"), "k", "a").count() == 0


def test_long_field(spark):
    df = spark.createDataFrame([(1, ", ".join(f"Bell{'x' * (i % 5)} A" for i in range(5_000)))], "k bigint, a string")
    assert packed.split_packed(df, "k", "a").count() == 5_000


def test_folding_and_shape():
    assert packed.shape("Bell-Ray AB, O'Orr C. D.") == "Aa A, Aa A."
    assert packed.form_of("Bell A, Ray B, Ito C, Orr D") == packed.form_of("Bell A, Ray B, Ito C, Orr D, Poe E")
