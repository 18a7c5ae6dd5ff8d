"""The stages on small source tables."""

import random

import pytest
from pyspark.sql import functions as F

from brevetlake.plans import boosting, codes, export, families, identification, licensing, participants, pipeline, publications, scope
from brevetlake.schemas import SOURCES
from brevetlake.sources import fetch, publish, tables
from brevetlake.streaming import events


def make(spark, name, *rows):
    schema = SOURCES[name]
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema) for r in rows], schema)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def source(spark):
    base = {"appln_kind": "A ", "ipr_type": "PI", "earliest_filing_year": 2012, "earliest_publn_year": 2013, "receiving_office": "", "granted": "N"}
    applications = [
        base | {"appln_id": 1, "appln_auth": "EP", "appln_nr": "1", "appln_filing_date": "2012-01-01", "earliest_publn_date": "2013-05-01", "earliest_pat_publn_id": 10, "docdb_family_id": 100, "inpadoc_family_id": 7, "granted": "Y", "reg_phase": "Y"},
        base | {"appln_id": 2, "appln_auth": "WO", "appln_nr": "2", "appln_filing_date": "2012-02-01", "earliest_publn_date": "2013-04-01", "docdb_family_id": 100, "inpadoc_family_id": 7, "appln_kind": "U ", "ipr_type": "UM", "int_phase": "N"},
        base | {"appln_id": 3, "appln_auth": "US", "appln_nr": "3", "docdb_family_id": 300, "appln_filing_date": "2012-01-01", "earliest_filing_year": 9999},
        base | {"appln_id": 4, "appln_auth": "US", "appln_nr": "4", "docdb_family_id": 400, "appln_filing_date": "2009-01-01", "earliest_filing_year": 2009},
        base | {"appln_id": 5, "appln_auth": "FR", "appln_nr": "5", "docdb_family_id": 500, "receiving_office": None, "appln_filing_date": "2012-01-01"},
    ]
    return {
        "application": make(spark, "application", *applications),
        "person": make(spark, "person", {"person_id": 1, "person_name": "Dupont Jean", "person_ctry_code": "FR", "doc_std_name_id": 5}, {"person_id": 2, "person_name": "Smith John", "person_ctry_code": "US"}, {"person_id": 3, "person_name": "Acme", "person_ctry_code": "RE"}),
        "person_appln": make(spark, "person_appln", {"appln_id": 1, "person_id": 1, "applt_seq_nr": 1, "invt_seq_nr": 1}, {"appln_id": 2, "person_id": 2, "applt_seq_nr": 1, "invt_seq_nr": 0}, {"appln_id": 3, "person_id": 1, "applt_seq_nr": 1}, {"appln_id": 5, "person_id": 1, "applt_seq_nr": 0, "invt_seq_nr": 1}),
        "publication": make(spark, "publication", {"pat_publn_id": 10, "publn_nr": "EP10", "publn_kind": "A1", "appln_id": 1, "publn_date": "2013-05-01", "publn_first_grant": "N"}, {"pat_publn_id": 11, "publn_nr": "EP11", "publn_kind": "B1", "appln_id": 1, "publn_date": "2015-01-01", "publn_first_grant": "Y"}),
        "priority": make(spark, "priority", {"appln_id": 2, "prior_appln_id": 1}),
        "title": make(spark, "title", {"appln_id": 1, "appln_title_lg": "en", "appln_title": "A pump"}, {"appln_id": 2, "appln_title_lg": "fr", "appln_title": "Une pompe"}),
        "abstract": make(spark, "abstract", {"appln_id": 2, "appln_abstract_lg": "de", "appln_abstract": "Eine Pumpe"}),
        "ipc": make(spark, "ipc", {"appln_id": 1, "ipc_class_symbol": "A61K  31/00"}),
        "cpc_appln": make(spark, "cpc_appln", {"appln_id": 2, "cpc_class_symbol": "A61K  31/00"}),
        "cpc_family": make(spark, "cpc_family", {"docdb_family_id": 100, "cpc_class_symbol": "Y02A 1/00"}),
        "class_label": make(spark, "class_label", {"symbol": "A61K", "libelle": "Preparations"}),
        "participant": make(spark, "participant"),
    }


def test_scope_takes_whole_families(source):
    found = scope.patent_scope(source["application"], source["person"], source["person_appln"])
    assert rows(found.select("appln_id", "key_appln_nr")) == [(1, "EP1A "), (2, "WO2U ")]


def test_phases_read_missing_codes(source):
    found = {r.appln_id: (r.international, r.oeb) for r in scope.phases(source["application"]).collect()}
    assert found[1] == (1, 1) and found[2] == (0, 0)


def test_pipeline(spark, source):
    out = pipeline.run(source)
    patent = {r.appln_id: r for r in out["patent"].collect()}
    assert (patent[1].ispriority, patent[2].ispriority) == (1, 0)
    assert (patent[1].first_publn_nr, patent[1].date_first_granted) == ("EP10", "2015-01-01")
    (family,) = out["family"].collect()
    assert (family.earliest_filing_date, family.earliest_publn_date, family.is_granted) == ("2012-01-01", "2013-04-01", 1)
    assert (family.patents_count, family.utility_models_count, family.design_patents_count) == (1, 1, 0)
    assert (family.title_en, family.title_fr, family.title_default, family.abstract_default) == ("A pump", "Une pompe", None, "Eine Pumpe")
    technology = rows(out["technology"].select("level", "code", "libelle"))
    assert ("ss_classe", "A61K", "Preparations") in technology and ("groupe", "A61K31/00", "non disponible") in technology and len(technology) == 8
    (document,) = [r.asDict(True) for r in out["document"].collect()]
    assert document["id"] == "patent100" and len(document["patents"]) == 2 and document["publications"] == []
    assert document["patents"][0]["link"].startswith("https://worldwide.espacenet.com/patent/search/?q=pn%3D%22EP")
    assert rows(out["roles"].select("role").distinct()) == [("dep",), ("inv",)]
    assert rows(export.green(out["technology"])) == [(100,)]


def test_documents_are_written_with_nulls(spark, source, tmp_path):
    tables.write_documents(pipeline.run(source)["document"], str(tmp_path / "docs"))
    (line,) = [r.value for r in spark.read.text(str(tmp_path / "docs")).collect()]
    assert '"title_default":null' in line


def test_preferred_texts(spark):
    data = [(1, "en", "EP one", "2012", "EP"), (1, "en", "WO one", "2012", "WO"), (1, "de", "deutsch", "2011", "EP"), (2, "it", "italiano", "2013", "EP"), (2, "de", "deutsch", "2014", "EP"), (2, "zh", "zh", "2010", "CN"), (3, "en", None, "2010", "EP"), (3, "en", "B", "2011", "EP")]
    df = spark.createDataFrame(data, "fam int, lang string, t string, d string, o string")
    assert rows(families.preferred_texts(df, "fam", "lang", "t", "d", "o", "x")) == [(1, "WO one", None, None, None), (2, None, None, "deutsch", "de"), (3, "B", None, None, None)]


def test_copy_within_family(spark):
    data = [(1, "FR", 1, "A"), (1, "EP", 1, None), (1, "EP", 2, None), (2, "EP", 1, "B"), (2, "EP", 1, "C"), (2, "US", 1, None), (3, "US", 1, None)]
    df = spark.createDataFrame(data, "fam int, appln_auth string, pos int, name string")
    assert rows(participants.copy_within_family(df, "fam", ["pos"], "name")) == sorted([(1, "FR", 1, "A"), (1, "EP", 1, "A"), (1, "EP", 2, None), (2, "EP", 1, "B"), (2, "EP", 1, "C"), (2, "US", 1, None), (3, "US", 1, None)], key=str)


def test_latin_names(spark):
    data = [(1, 10, 1, "Иванов", False), (1, 11, 1, "Ivanov", True), (2, 20, 1, "李 A", False), (2, 21, 1, "Ada", True)]
    # Neither has an initial that the other's two spaces could share.
    data += [(3, 30, 1, "李 王", False), (3, 31, 1, "Ada  Lovelace", True), (4, 40, 1, "Петров", False), (4, 41, 1, "Ivanov", True)]
    df = spark.createDataFrame(data, "fam int, app int, pos int, name string, latin boolean")
    out = rows(participants.latin_names(df, "fam", "app", ["pos"], "name", "latin").select("fam", "app", "name"))
    assert (2, 20, "Ada") in out and (1, 10, "Ivanov") in out
    assert (3, 30, "李 王") in out and (4, 40, "Петров") in out


def test_organisations(spark):
    data = [("k1", 1, "p1", "n1", "ACME", "000000000", None, "FR", 5), ("k2", 1, "p2", "n2", "ACME", None, None, "FR", 5), ("k3", 2, "p3", "n3", "Other", "552 100 554", None, "US", None)]
    df = spark.createDataFrame(data, "key_appln_nr_person string, inpadoc_family_id int, publn string, name_source string, name_corrected string, siren string, siret string, country_corrected string, psn_id int")
    register = spark.createDataFrame([("p1", "n1", "552100554")], "publn string, name_source string, siren string")
    out = {r.key_appln_nr_person: r.siren for r in participants.organisations(df, register, trusted=[5]).collect()}
    assert out == {"k1": "552100554", "k2": "552100554", "k3": None}


def test_external_ids_and_names(spark):
    df = spark.createDataFrame([("k", "1", "('a', 'b')", None, "", None, None)], "key_appln_nr_person string, siren string, siret string, id_paysage string, idref string, grid string, ror string")
    assert rows(participants.external_ids(df)) == [("k", "siren", "1"), ("k", "siret", "a"), ("k", "siret", "b")]
    names = spark.createDataFrame([(1, "c", "DR. jean-paul martin", "EP"), (1, "c", "J Martin", "EP"), (1, "c", "Jean", "CN")], "fam int, cluster string, name string, office string")
    assert rows(participants.nice_names(names, "fam", "cluster", "name", "office")) == [(1, "c", "Dr. Jean-Paul Martin")]


def test_classifier(spark):
    people = [(f"person {n} martin", 1, 1.0) for n in "abcdefghij"] + [(f"company {n} ltd", 0, 0.0) for n in "abcdefghij"]
    df = spark.createDataFrame(people, "person_name string, invt_seq_nr int, label double")
    model = participants.classifier(df, "label", ["person_name"])
    known = spark.createDataFrame([("company a ltd", "pp")], "person_name string, type string")
    out = {r.person_name: r.type for r in participants.classify(df.drop("label"), model, known, ["person_name"]).collect()}
    assert out["person a martin"] == "pp" and out["company b ltd"] == "pm" and out["company a ltd"] == "pp"


def test_classifier_on_names_it_has_not_seen(spark):
    """Names made of parts, held out by their last part: nine of ten right at least."""
    rng = random.Random(3)
    given, family = "jean marie anna pierre luc sophie karl ines paul eva hugo lena".split(), [a + b for a in "du mar le ber gar mo lam".split() for b in "pont tin roux nard nier rel bert".split()]
    things, forms = [a + b for a in "aero bio chem electro geo hydro micro".split() for b in "tech plast metal soft gen nics".split()], "sa ltd gmbh inc corp sas".split()
    persons = [(f"{f}, {rng.choice(given)}", 1, 1.0, k % 3) for k, f in enumerate(family)]
    companies = [(f"{t} {rng.choice(forms)}", 0, 0.0, k % 3) for k, t in enumerate(things)]
    df = spark.createDataFrame(persons + companies, "person_name string, invt_seq_nr int, label double, fold int").withColumn("invt_seq_nr", F.lit(1))
    model = participants.classifier(df.where("fold > 0").drop("fold"), "label", ["person_name"])
    known = spark.createDataFrame([], "person_name string, type string")
    out = participants.classify(df.where("fold = 0").select("person_name", "invt_seq_nr", "label"), model, known, ["person_name"]).collect()
    assert sum((r.type == "pp") == (r.label == 1) for r in out) > 0.9 * len(out)


def test_identify(spark):
    df = spark.createDataFrame([("k1", "p1", "Acmé", 1, "x"), ("k2", "p2", "Beta", 1, "x"), ("k3", "p9", "Gamma", 9, "y"), ("k4", "p9", "Delta", 9, "z")], "key string, publn string, name_corrected string, fam int, address string")
    register = spark.createDataFrame([("p1", "ACME", "111", 5), ("p8", "beta", "222", 1)], "publn string, nom string, siren string, fam int")
    gazette = spark.createDataFrame([("GAMMA", "333"), ("delta", "444"), ("delta", "445")], "nom string, siren string")
    solved = spark.createDataFrame([("Delta", "q", "555")], "name_corrected string, address string, siren string")
    assert rows(identification.identify(df, ["key"], register, gazette, solved, "fam")) == [("k1", "111", "register"), ("k2", "222", "family"), ("k3", "333", "gazette"), ("k4", "555", "name")]


def test_rungs_of_the_register_and_of_houses(spark):
    people = [("k1", "p1", 1, "Acmé"), ("k2", "p1", 2, "Beta"), ("k3", "p2", 1, "Gama"), ("k4", "p3", 1, "Delta"), ("k5", None, None, "Eta")]
    df = spark.createDataFrame([(*p, 1, None, "3-7" if p[0] == "k5" else None, "Paris", "75001") for p in people], "key string, publn string, sequence int, name_corrected string, fam int, address string, house string, city string, postcode string")
    # k1: equal name; k2: by name one number, by place another, both by a third entry; k3: the nearest; k4: two nearest.
    register = spark.createDataFrame([("p1", "9", "ACME", "1"), ("p1", "7", "beta", "2"), ("p1", "2", "other", "3"), ("p1", "2", "BETA", "4"), ("p2", "5", "gamma", "5"), ("p2", "6", "omega", "6"), ("p3", "5", "delt", "7"), ("p3", "5", "elta", "8")], "publn string, sequence string, nom string, siren string").withColumn("fam", F.lit(9))
    gazette = spark.createDataFrame([("Delta", "69001", "9"), ("Delta", "75001", "10")], "nom string, postcode string, siren string")
    solved = spark.createDataFrame([("Eta", None, "5", "Paris", "11"), ("Eta", None, "4", "Paris", "12")], "name_corrected string, address string, house string, city string, siren string")
    assert rows(identification.identify(df, ["key"], register, gazette, solved, "fam")) == [("k1", "1", "register"), ("k2", "4", "register_both"), ("k3", "5", "register_nearest"), ("k4", "10", "gazette_postcode"), ("k5", "11", "house")]


def test_registry_fallback(spark):
    df = spark.createDataFrame([("k1", 1, "s", "A", "i1", "FR", None), ("k2", 1, "s", "B", None, None, None), ("k3", 2, None, "A", "i1", "US", None), ("k4", 3, None, "C", "i2", "FR", None), ("k5", 4, None, "D", "i1", None, "known")], "key string, fam int, siren string, name_corrected string, id_paysage string, country_corrected string, city_code string")
    registry = spark.createDataFrame([("i1", "75101"), ("i2", "1"), ("i2", "2"), (None, "3")], "id_paysage string, city_code string")
    out = {r.key: r.city_code for r in identification.registry_fallback(df, registry, "fam", ["city_code"]).collect()}
    assert out == {"k1": "75101", "k2": "75101", "k3": None, "k4": None, "k5": "known"}


def test_unknown_types_lose_nobody(spark):
    people = [("a", None, "1", 0, 1), ("b", "pm", "1", None, 1), ("c", None, None, None, 2), ("d", "pp", "1", 1, 1), ("e", None, "1", None, 3)]
    df = spark.createDataFrame(people, "name string, type string, grid string, applt_seq_nr int, invt_seq_nr int")
    for c in export.IDS[1:]:
        df = df.withColumn(c, F.lit(None).cast("string"))
    applicants, inventors = export.split_roles(df)
    assert [r.name for r in applicants.orderBy("name").collect()] == ["b", "d"]
    assert [r.name for r in inventors.orderBy("name").collect()] == ["a", "c", "d", "e"]


def test_carry_over_takes_the_first_of_several_rows(spark):
    history = spark.createDataFrame([("k", "b", "pm"), ("k", "a", None), ("k", "a", "pp"), ("k", None, "aa")], "key string, name_corrected string, type string")
    assert rows(participants.carry_over(spark.createDataFrame([("k",), ("l",)], "key string"), history, ["key"])) == [("k", "a", "pp"), ("l", None, None)]


def test_geocode(spark):
    df = spark.createDataFrame([("k1", 1, "1", "A", "paris"), ("k2", 1, "1", "A", None), ("k3", 2, None, "B", "two")], "key string, fam int, siren string, name_corrected string, address string")
    snapshot = spark.createDataFrame([("paris", 0.9, "75056", "Paris", "75001", "75, Paris, Ile"), ("two", 0.8, "1", "X", "1", "1, A, B"), ("two", 0.8, "2", "Y", "2", "2, A, B"), ("paris", 0.4, "9", "Z", "9", "9, z, z")], "input_address string, score double, city_code string, city string, post_code string, context string")
    districts = spark.createDataFrame([("75001", "75101", "Paris 1er")], "post_code string, city_code string, city string")
    out = {r.key: (r.city_code, r.dep_id) for r in identification.geocode(df, snapshot, ["key"], districts, "fam").collect()}
    assert out == {"k1": ("75101", "D075"), "k2": ("75101", "D075"), "k3": (None, None)}
    house = spark.createDataFrame([("3-7", "5"), ("3-7", "4")], "a string, b string")
    assert [r[0] for r in house.select(identification.same_house(F.col("a"), F.col("b"))).collect()] == [True, False]


def test_publications(spark):
    npl = spark.createDataFrame([("n1", "b", "10.1/x", "a 10.1000/AB, 10.2000/c"), ("n2", "s", None, "10.3000/q"), ("n3", "s", "doi: 10.9/z", None)], "npl_publn_id string, npl_type string, npl_doi string, npl_biblio string")
    assert rows(publications.cited_dois(npl)) == [("n1", "10.1/x"), ("n1", "10.1000/ab"), ("n1", "10.2000/c"), ("n3", "10.9/z")]
    cites = spark.createDataFrame([(10, "n1"), (11, "n3")], "pat_publn_id int, cited_npl_publn_id string")
    pubs = spark.createDataFrame([(10, 1), (11, 2)], "pat_publn_id int, appln_id int")
    assert rows(publications.patents_of_dois(spark.createDataFrame([(" 10.9/Z ",)], "doi string"), npl, cites, pubs)) == [("10.9/z", 2)]
    dump = spark.createDataFrame([("10.1/x", "T&amp;x", "article", "2019-01-01", [("Ann", "https://orcid.org/0000-0001-0002-000X", ["r1"])])], "doi string, title string, type string, publication_date string, authors array<struct<name: string, orcid: string, rors: array<string>>>")
    cited = spark.createDataFrame([("10.1/x", "s", "old", "20180101"), ("10.9/z", "B", "a <i>b</i>", "20170000")], "doi string, npl_type string, npl_title1 string, npl_publn_date string")
    places = spark.createDataFrame([("r1", "p1"), ("r2", "p2"), ("r2", "p3")], "ror string, id string")
    people = spark.createDataFrame([("0000-0001-0002-000X", "i1")], "orcid string, idref string")
    out = {r.doi: tuple(r)[1:] for r in publications.enrich(cited, dump, places, people).collect()}
    assert out["10.1/x"] == ("T&x", "journal-article", 2019, "Ann", "0000-0001-0002-000X", "i1", "r1", "p1")
    assert out["10.9/z"][:3] == ("a <i>b</i>", "book", 2017)


def test_licensing(spark):
    data = [(1, 1, "EP", "L1", "LIC"), (2, 1, "EP", "L1", None), (3, 2, "US", "F", None), (4, 3, "EP", "L1", None)]
    df = spark.createDataFrame(data, "event_id int, appln_id int, event_auth string, event_code string, party_type string")
    described = spark.createDataFrame([("EP", "L1", "Licence granted"), ("US", "F", None)], "event_auth string, event_code string, text string")
    patents = spark.createDataFrame([(1,), (2,)], "appln_id int")
    out = licensing.licensing_events(df, licensing.licence_codes(described, ("text",)), patents)
    assert rows(out.select("event_id")) == [(1,), (2,)]


def test_code_labels(spark):
    xml = "<cpc>" + "".join(f'<classification-item sort-key="{s}" level="{v}"><class-title><title-part><text>{t}</text></title-part></class-title></classification-item>' for s, v, t in [("A", "2", "Needs"), ("A61K", "5", "Prep"), ("A61K31/00", "7", "Organic"), ("A61K31/01", "8", "Hydro"), ("A61K31/02", "9", "Halo"), ("A61", "3", "skip")]) + "</cpc>"
    items = codes.scheme(spark.createDataFrame([(xml,)], "x string"), "x")
    assert ("A61K31/02", "9", "Halo") in rows(items)
    out = {r.symbol: (r.ref, r.libelle) for r in codes.labels(items).collect()}
    assert out["A61K31/02"] == ("A61K31/01", "Organic - Hydro") and out["A61K31/00"] == ("A61K31/00", "Organic") and "A61" not in out


def test_sources(spark, tmp_path):
    folder = tmp_path / "tls204"
    folder.mkdir()
    for k in range(2):
        (folder / f"part{k}.csv").write_text(f"appln_id,prior_appln_id,prior_appln_seq_nr\n{k},{k + 10},1\n5,,2\n")
    df = tables.scan_parts(spark, str(folder), "priority", lambda d: d.where("prior_appln_id is not null"))
    assert rows(df) == [(0, 10, 1), (1, 11, 1)]
    assert rows(tables.scan_keys(df, spark.createDataFrame([(1,), (1,)], "k long"), "appln_id")) == [(1, 11, 1)]
    tables.write_delimited(df, str(tmp_path / "out"))
    assert rows(tables.read_delimited(spark, str(tmp_path / "out"), "priority", sep="|")) == rows(df)
    (tmp_path / "a.json").write_text('[{"a": 1}, {"a": 2}]')
    assert rows(tables.read_json(spark, str(tmp_path / "a.json"), "a int", array=True)) == [(1,), (2,)]
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "FR123.xml").write_text("<docs><doc><name>A</name></doc><doc><name>B</name></doc></docs>")
    assert rows(tables.read_xml(spark, str(tmp_path / "x"), "doc", "name string")) == [("A",), ("B",)]
    assert rows(tables.files(spark, str(tmp_path / "x"), "*.xml").select("name", "number")) == [("FR123.xml", "FR123")]
    xml = spark.createDataFrame([(1, "<d><p><a><n>x</n></a><a><n>y</n><c>FR</c></a></p></d>")], "id int, xml string")
    assert rows(tables.xml_records(xml, "xml", [("applicant", "/d/p/a")], {"name": "n", "country": "c"})) == [(1, "applicant", 1, "x", ""), (1, "applicant", 2, "y", "FR")]
    cache = spark.createDataFrame([(0, "z")], "appln_id long, v string")
    assert rows(tables.missing(df.select("appln_id"), cache, ["appln_id"])) == [(1,)]
    assert rows(tables.lookup(df.select("appln_id"), cache, ["appln_id"])) == [(0, "z", True), (1, None, False)]
    tables.write_table(spark.range(3), str(tmp_path / "t"), drop_zero_id=F.col("id"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_stream_equals_batch(spark, tmp_path):
    data = [(k, f"2020-01-01 0{k % 3}:10:00", "click" if k % 2 else "view", float(k)) for k in range(12)]
    df = spark.createDataFrame(data, "event_id int, t string, event_type string, value double").withColumn("ts", F.col("t").cast("timestamp"))
    path = str(tmp_path / "events")
    df.repartition(3).write.parquet(path)
    stream = events.windowed_counts(events.read_events(spark, path, 1))
    assert rows(events.run_to_memory(stream, "counts")) == rows(events.windowed_counts(spark.read.parquet(path)))


def test_boosted_trees_beside_the_logistic_model(spark):
    """Names whose first word says nothing: the class follows from a word anywhere and from office and city together; unseen words have no share.  Held out by row."""
    rng = random.Random(5)
    forms, given, places = "gmbh sarl holding institut".split(), "jean marie karl ines".split(), [f"city{k}" for k in range(40)]
    data = []
    for k in range(1200):
        office, city, own = rng.choice("EP FR US WO".split()), rng.choice(places), f"own{rng.randrange(10**6)}"
        sure = rng.random() < 0.5
        person = rng.random() < 0.5 if sure else office in ("EP", "FR") and int(city[4:]) < 20
        middle = [rng.choice(given if person else forms)] if sure else []
        data.append((f"alpha {' '.join(rng.sample([own, *middle], 1 + len(middle)))} beta", office, city, 1, float(person), k % 3))
    df = spark.createDataFrame(data, "person_name string, office string, city string, invt_seq_nr int, label double, fold int")
    training, held = df.where("fold > 0").drop("fold"), df.where("fold = 0").drop("fold")
    model = boosting.fit(training, "label", ["office", "city"], "person_name")
    right = lambda out: sum((r.type == "pp") == (r.label == 1) for r in out.collect()) / held.count()
    boosted = right(boosting.predict(held, model))
    logistic = participants.classifier(training, "label", ["person_name"])
    plain = right(participants.classify(held, logistic, spark.createDataFrame([], "person_name string, type string"), ["person_name"]))
    assert boosted > 0.93 and boosted > plain + 0.05
    odd = spark.createDataFrame([(None, None, None), ("new words only", "XX", "")], "person_name string, office string, city string")
    assert boosting.predict(odd, model).count() == 2
    with pytest.raises(ValueError, match="label"):
        boosting.fit(training.withColumn("label", F.lit(None).cast("double")), "label", ["office"])


def test_no_row_sees_its_own_label(spark):
    """A category that every row has for itself says nothing: the trees don't learn it by heart."""
    rng = random.Random(6)
    df = spark.createDataFrame([(f"id{k}", float(rng.random() < 0.5)) for k in range(600)], "id string, label double")
    model = boosting.fit(df, "label", ["id"], rounds=5)
    out = boosting.predict(spark.createDataFrame([(f"new{k}",) for k in range(50)], "id string"), model).collect()
    assert len({round(r.probability, 6) for r in out}) == 1


def test_a_closure_is_kept_up_from_changes(spark):
    """Over editions with random changes of applications, roles and persons: the same supports and families as from the whole tables."""
    rng = random.Random(8)
    names = ("app", "person", "family")
    frames = lambda e: (spark.createDataFrame(sorted(e[0].items()), "app int, family int"), spark.createDataFrame(sorted(e[1]), "app int, person int"), spark.createDataFrame([(p,) for p in sorted(e[2])], "person int"))
    now = ({a: rng.choice([None, *range(12)]) for a in range(60)}, {(rng.randrange(60), rng.randrange(25)) for _ in range(90)}, set(range(0, 25, 3)))
    kept = scope.supports(*frames(now), *names)
    for _ in range(4):
        old = now
        apps = {a: f for a, f in old[0].items() if rng.random() > 0.1} | {rng.randrange(70): rng.randrange(12) for _ in range(6)}
        now = (apps, {r for r in old[1] if rng.random() > 0.1} | {(rng.randrange(70), rng.randrange(25)) for _ in range(8)}, set(rng.sample(range(25), 8)))
        (a0, r0, p0), (a1, r1, p1) = frames(old), frames(now)
        new = scope.refreshed(kept, [scope.changed_keys(a0, a1, "app"), scope.changed_keys(r0, r1, "app")], scope.changed_keys(p0, p1, "person"), a1, r1, p1, *names)
        whole = scope.supports(a1, r1, p1, *names)
        assert rows(new) == rows(whole)
        families = lambda df: {r.family for r in df.collect()}
        moved = {(r.family, r.change) for r in scope.moved_families(kept, new, "family").collect()}
        assert moved == {(f, "in") for f in families(whole) - families(kept)} | {(f, "out") for f in families(kept) - families(whole)}
        kept = tables.written(new)


def test_readers_see_whole_versions_only(spark, tmp_path):
    path = f"file://{tmp_path}/table"
    with pytest.raises(FileNotFoundError):
        publish.published(spark, path)
    publish.publish(spark.range(10).withColumn("part", F.col("id") % 2), path, ["part"])
    before = publish.published(spark, path)
    failing = spark.range(20).withColumn("part", F.when(F.col("id") == 19, F.raise_error(F.lit("no"))).otherwise(F.col("id") % 2).cast("long"))
    with pytest.raises(Exception, match="no"):
        publish.publish(failing, path, ["part"], attempts=2, wait=0)
    assert publish.published(spark, path).count() == before.count() == 10 and len(publish.versions(spark, path)) == 1
    # Its own rows, partly, and a partition anew; who has begun with the first version still reads it.
    publish.publish_partitions(spark.createDataFrame([(100, 1)], "id long, part long"), path, ["part"])
    assert rows(publish.published(spark, path).select("id", "part")) == sorted([*((i, 0) for i in range(0, 10, 2)), (100, 1)], key=str)
    assert before.count() == 10
    publish.publish(publish.published(spark, path).where("id < 4"), path)
    assert rows(publish.published(spark, path).select("id")) == [(0,), (2,)]
    assert len(publish.versions(spark, path)) == 2 and not [p for p in (tmp_path / "table").iterdir() if p.name.startswith("draft")]


def test_a_failed_write_is_tried_again(spark, tmp_path):
    path, tries = f"file://{tmp_path}/table", []

    def write(folder):
        tries.append(folder)
        if len(tries) < 3:
            raise OSError("busy")
        spark.range(3).write.parquet(folder)

    publish._publish(spark, path, write, 3, 0, 2)
    assert len(tries) == 3 and publish.published(spark, path).count() == 3


def test_fetching_what_a_cache_lacks(spark, tmp_path):
    """Every key ends in the cache or among the failed ones; a bad key does not cost its batch; nothing known is asked for again."""
    path = f"file://{tmp_path}/cache"

    def ask(asked):
        if "7" in asked:
            raise OSError("bad key")
        return {k: f"answer {k}" for k in asked if k != "5"}

    wanted = spark.createDataFrame([(k,) for k in [*range(120), 3, 3]] + [(None,)], "doi int")
    failed = fetch.refresh(spark, wanted, "doi", path, ask, wait=0, workers=2)
    assert [tuple(r) for r in failed.collect()] == [("7", "OSError: bad key")]
    cache = {r.doi: r.answer for r in publish.published(spark, path).collect()}
    assert cache == {str(k): None if k == 5 else f"answer {k}" for k in range(120) if k != 7}

    def nothing_known(asked):
        assert set(asked) <= {"7", "500"}
        return {"500": "new"}

    fetch.refresh(spark, wanted.union(spark.createDataFrame([(500,)], "doi int")), "doi", path, nothing_known, wait=0)
    assert publish.published(spark, path).count() == 121

    def down(asked):
        raise TimeoutError("down")

    with pytest.raises(fetch.TooManyFailures, match="2 of 2"):
        fetch.refresh(spark, spark.createDataFrame([(900,), (901,), (1,)], "doi int"), "doi", path, down, wait=0)
    assert publish.published(spark, path).count() == 121


def test_answers_are_saved_before_failures_stop_the_job(spark, tmp_path):
    path = f"file://{tmp_path}/cache"

    def half(asked):
        if any(int(k) % 2 for k in asked):
            raise OSError("odd")
        return dict.fromkeys(asked, "even")

    with pytest.raises(fetch.TooManyFailures, match="10 of 20"):
        fetch.refresh(spark, spark.range(20).withColumnRenamed("id", "doi"), "doi", path, half, wait=0, attempts=1)
    assert {r.doi for r in publish.published(spark, path).collect()} == {str(k) for k in range(0, 20, 2)}
