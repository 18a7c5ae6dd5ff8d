"""Functions on hand-written rows."""

import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from brevetlake.functions import dates, formulas, fuzzy, rules, scripts, text


def column(spark, values, f, kind="string"):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, c {kind}")
    return [r[0] for r in rows.orderBy("k").select(f(F.col("c"))).collect()]


CASES = [
    (text.without_punctuation, ["  a-b,  c! ", None, ""], ["a b c", None, ""]),
    (lambda c: text.without_punctuation(c, keep="-"), ["a-b.c"], ["a-b c"]),
    (text.without_accents, ["Élève ñ", None], ["Eleve n", None]),
    (text.title_case, ["JEAN-pierre o'neil"], ["Jean-Pierre O'Neil"]),
    (lambda c: text.clean_name(c, ["^dr ", r"\d\)"]), ["DR. Élie  O'Neil", None], ["elie o neil", None]),
    (text.words_in_order, ["b a c"], ["a b c"]),
    (lambda c: F.array_join(text.initials(c), "."), ["ab cd", ""], ["a.c", ""]),
    (text.has_initial, ["a blanc", "al blanc"], [True, False]),
    (text.has_several_names, ["a, b, c", "a, b", "a;b;c"], [True, False, True]),
    (text.is_ascii, ["abc", "é", ""], [True, False, True]),
    (text.address_line, ["12 rue x 75001 paris cedex 05", "1 rue y bp 12 69001 lyon fr"], ["12 rue x 75001 paris", "1 rue y 69001 lyon"]),
    (text.address_key, ['F-75014 "PARIS", c/o X', "-- 3 Rue_Y & Z, Cedex 12"], ["75014 paris x", "3 rue y z"]),
    (text.department, ["12 rue 75001 Paris 69002", "none"], ["69", ""]),
    (text.postcode_and_city, ["12 rue 75001  Paris", "none"], ["75001 Paris", ""]),
    (text.only_postcode, ["1 rue, 75001 Paris", "75001 69001", "none", "75001, 75001"], ["75001", "", "", "75001"]),
    (text.valid_siren, ["552 100 554", "000000000", "12345678", None], ["552100554", None, None, None]),
    (text.siren_of_siret, ["552 100 554 00012", "552100554"], ["552100554", None]),
    (lambda c: F.array_join(text.tuple_items(c), "|"), ["('a', 'b')", "x", "()"], ["a|b", "x", ""]),
    (lambda c: F.array_join(text.dois(c), "|"), ["see 10.1000/AbC.1 and 10.1000/abc.1, 10.5/x", ""], ["10.1000/abc.1", ""]),
    (text.clean_doi, ["DOI: 10.1/X", "https://doi.org/10.1/x", "* 10.1/?x"], ["10.1/x", "10.1/x", "10.1/x"]),
    (lambda c: F.array_join(text.house_range(c).cast("array<string>"), ","), ["3-7", "3 bis", "2-5", "x"], ["3,5,7", "3", "2,5", ""]),
    (text.repaired_encoding, ["FranÃ§ois", "plain\x00", "déjà"], ["François", "plain", "déjà"]),
    (text.to_ascii, ["Straße Œuvre ø", "日本 a", "Иванов", "Щербаков Юрий", "ΑΘΗΝΑ", "トヨタ さくら", None, ""], ["strasse oeuvre o", " a", "ivanov", "shcherbakov yurii", "athena", "toyota sakura", None, ""]),
    (scripts.transliterated, ["Abc", "Ёлка é", None], ["Abc", "elka é", None]),
    (text.clean_scientific, [r"$\frac{\partial u}{\sqrt{a+{b}}}$ in \mathbf{m}^{2}", r"a \frac{1}{2", r"50\% of \unknown{x} {y}", r"\hat{x} and \'e", "a {b} c"], ["∂ u/√(a+b) in m^2", "a 1/2", "50% of x y", "x̂ and é", "a {b} c"]),
    (text.clean_scientific, ["&amp;amp;lt;sub&amp;amp;gt;2&lt;/sub&gt; a%20b+c", "$\\alpha$x<p>y</p>", None, "a–b"], ["<sub>2</sub> a b+c", "α xy", None, "a-b"]),
    (lambda c: rules.repair(c, [rules.Rule("Ã", "É"), rules.Rule("Ã©", "é")]), ["Ã©"], ["É©"]),
    (lambda c: rules.repair(c, rules.LOOKALIKES), ["АBС", "АВС"], ["ABC", "АВС"]),
    (rules.is_latin, ["abc é 1!", "日本", ""], [True, False, True]),
    (dates.as_midnight, ["2015-01-01", "2015", None], ["2015-01-01T00:00:00", None, None]),
    (dates.compact_date, ["20150203", "20150000", "201502", "201500", "x"], ["2015-02-03", "2015", "2015-02", "2015", "x"]),
    (dates.year_of, ["2015-01-01", "", "abcd", None, "20"], [2015, None, None, None, 20]),
    (dates.yes_no, ["1", "0", "abc", "", None], ["oui", "non", None, None, None]),
    (dates.id_text, ["0", "7", "abc", "", None, "0.0"], ["", "7", "abc", "", None, ""]),
    (lambda c: F.array_join(text.house_range(c).cast("array<string>"), ","), ["12 99999999999", "2-2000000", "99999999999", "2-6 "], ["12", "2,2000000", "", "2,4,6"]),
    (text.clean_doi, ["10.1016/j.ajpath. 2014.11.02 9", "10.1 0L 6/ J.SOLMAT.2017 .06.023", "10.1.1.75.1021", "https://onlinelibrary.wiley.com/doi/10.1/X", "10.5//a b", None], ["10.1016/j.ajpath.2014.11.029", "10.1016/j.solmat.2017.06.023", "10.5281/zenodo.40463", "10.1/x", "10.5/ab", None]),
    (dates.valid_year_or_day, ["2015", "20150230", "20150228", "x"], [True, False, True, False]),
]


@pytest.mark.parametrize("case", range(len(CASES)))
def test_function(spark, case):
    f, values, want = CASES[case]
    assert column(spark, values, f) == want


def test_many_rules_stay_small(spark):
    many = [rules.Rule(chr(0x400 + k), "x", when="[a-z]") for k in range(60)]
    assert column(spark, ["a" + chr(0x400), chr(0x400)], lambda c: rules.repair(c, many)) == ["ax", chr(0x400)]


def _subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b, 1):
            row[j] = before[j - 1] + 1 if x == y else max(before[j], row[j - 1])
    return row[-1]


def test_ratio_against_the_plain_recurrence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcé ") for _ in range(rng.randrange(12))) for _ in range(2))
        want = int(round(200 * _subsequence(a, b) / (len(a) + len(b)))) if a and b else 0
        assert fuzzy.ratio(a, b) == want


def test_token_ratios():
    assert fuzzy.token_sort_ratio("Stanton, Jacques", "jacques stanton") == 100
    assert fuzzy.token_set_ratio("jean paul marie dupont", "dupont jean") == 100
    assert fuzzy.token_set_ratio("", "a") == 0
    assert fuzzy.initials_score("a blanc", "michel blanc") == 0
    assert fuzzy.initials_score("m blanc", "michel blanc") == 100


@pytest.mark.parametrize(
    ("formula", "want"),
    [
        (r"\sqrt[3]{x}", "3√(x)"), (r"\frac12", "1/2"), (r"\frac{\frac{a}{b}}{c}", "a/b/c"), (r"{a{b}", "ab"), (r"a}b}", "ab"), (r"\frac{a", "a/"), (r"\frac", "/"), (r"\sqrt[3", "√([3)"), (r"\sqrt", "√()"), ("\\", ""), ("", ""),
        (r"\begin{array}{cc}x\end{array}", "x"), (r"\left(\alpha\beta\right)", "(αβ)"), (r"a[b]c", "a[b]c"), (r"\{x\} \& y", "{x} & y"), (r"\sum_{i=1}^{n} i", "∑_i=1^n i"), (r"\bar y\vec{v}", "ȳv⃗"), (r"\c{c}\"o", "çö"),
    ],
)
def test_formula(formula, want):
    assert formulas.plain(formula) == want


def test_deep_and_long_formulas():
    assert formulas.plain("{" * 100_000 + "x" + "}" * 100_000) == "x"
    assert formulas.plain(r"\frac{1}{" * 5_000 + "x" + "}" * 5_000) == "1/" * 5_000 + "x"
    assert formulas.plain(r"\alpha " * 200_000) == "α " * 200_000
    assert formulas.plain("{" * 50_000 + r"\frac" * 1_000) == "/" + "/" * 999


def test_letters_of_scripts():
    table = scripts.letters()
    assert all(v.isascii() for v in table.values())
    assert {table[c] for c in "жЖ"} == {"zh"} and table["ь"] == "" and table["я"] == "ya" and table["ё"] == table["е"] == "e"
    assert (table["Ψ"], table["ή"], table["か"], table["ガ"]) == ("ps", "e", "ka", "ga")


def test_sign_repairs(spark):
    """The fold over a table behind its one scan gives what rule after rule gives, on names with and without spoilt signs."""
    rng = random.Random(9)
    parts = [p if not regex else rng.choice(["• ", ".**", ":", " ;", "03;", " [", "[FR]", "(FR)", "§", " }"]) for p, _, regex in rules.SIGN_REPAIRS] + ["Dupont", "LABO ", "é", " "]
    names = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 6))) for _ in range(400)] + ["plain name", "", None, "SOCIÉTÉ: X", ": A ;", "a\\nb"]
    table = rules.sign_rules()
    plain = column(spark, names, lambda c: rules.repair(c, table))
    assert column(spark, names, lambda c: rules.repair_where_needed(c, table)) == plain
    assert plain[-6:] == ["plain name", "", None, "SOCIÉTÉ: X", "A", "ab"]


def test_the_plan_does_not_grow_with_the_rules(spark):
    plan = lambda n: spark.range(1).select(rules.repair_where_needed(F.col("id").cast("string"), [rules.Rule("a", "b")] * n))._jdf.queryExecution().analyzed().toString()
    size = lambda n: sum(plan(n).count(x) for x in ("replace(", "CASE WHEN", "lambda", "struct"))
    assert size(1) == size(500)
    with pytest.raises(ValueError, match="conditional"):
        rules.repair_where_needed(F.col("id"), rules.LOOKALIKES)


def test_ascii_of_every_character(spark):
    """All characters, alone among letters and beside each other, as Python decomposes them; no text goes to a Python worker."""
    points = [chr(k) for k in range(1, 0x110000) if not 0xD800 <= k < 0xE000]
    texts = [sep.join(points[k : k + 200]) for sep in ("", "aB") for k in range(0, len(points), 200)]
    letters = scripts.letters()
    want = lambda t: unicodedata.normalize("NFKD", "".join(letters.get(x, x) for x in t).translate(text._ASCII)).encode("ascii", "ignore").decode().lower()
    found = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", text.to_ascii(F.col("t")).alias("t"))
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    found = dict(found.collect())
    assert [k for k, t in enumerate(texts) if found[k] != want(t)] == []
