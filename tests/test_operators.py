"""Frame operators: projections, cleansing, vintages, lookups, profiles."""

import pytest
from pyspark.sql import functions as F

from regstat import dims, schemas
from regstat.operators import classify, cleanse, profile, shape, vintage
from regstat.sources import fixtures as fx

from .conftest import one


def test_drop_strict_rejects_missing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert shape.drop_strict(df, ["a"]).columns == ["b"]
    with pytest.raises(ValueError):
        shape.drop_strict(df, ["a", "zz"])


def test_rename_by_dict_keeps_unknown_and_dotted_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`CNAE 2.0 Classe` int, `Tipo Estab.1` int, other int")
    out = shape.rename_by_dict(df, {"CNAE 2.0 Classe": "cnae_2_classe", "Tipo Estab.1": "ctg", "absent": "x"})
    assert out.columns == ["cnae_2_classe", "ctg", "other"]


def test_disambiguate_by_position_not_index(spark):
    df = spark.createDataFrame([(1, "CNPJ", 3)], "`tipo_estab7` int, `tipo_estab9` string, z int")
    out = shape.disambiguate(df, {"tipo_estab": ["tipo_estab", "tipo_estab_dsc"]})
    assert out.columns == ["tipo_estab", "tipo_estab_dsc", "z"]


def test_stack_vintages_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2,)], "k int")
    rows = shape.stack_vintages([a, b]).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, "x"), (2, None)]


def test_decode_sentinels_only_touches_strings(spark):
    df = spark.createDataFrame([("0000-1", -1, "{ñ class}")], "a string, b int, c string")
    r = one(cleanse.decode_sentinels(df))
    assert (r["a"], r["b"], r["c"]) == ("-1", -1, "-1")


def test_null_to_unknown_keeps_types(spark):
    df = spark.createDataFrame([(None, None)], "a string, b int")
    out = cleanse.null_to_unknown(df, ["a", "b"])
    assert dict(out.dtypes) == {"a": "string", "b": "int"}
    assert tuple(one(out)) == ("-1", -1)


def test_conform_try_casts_and_orders(spark):
    df = spark.createDataFrame([("40000", "7", "x")], "b string, a string, extra string")
    schema = schemas._struct([("a", schemas._S), ("b", schemas._S), ("c", schemas._I)])
    out = cleanse.conform(df, schema, may_lack=("c",))
    assert out.columns == ["a", "b", "c"]
    assert tuple(one(out)) == (7, None, None)            # smallint overflow → NULL
    with pytest.raises(ValueError, match="'c'"):
        cleanse.conform(df, schema)


def test_missing_columns_are_named(spark):
    from regstat.plans import flows
    from regstat.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    links = fx.raw_links(spark, sf)
    with pytest.raises(ValueError, match="vl_remun_dezembro_nom"):
        flows.links_stage1(links.drop("Vl Remun Dezembro Nom"), "t")
    with pytest.raises(ValueError, match="raca_cor"):
        flows.standardize_links(links.drop("Raça Cor"), "t")
    flows.standardize_links(links.drop("Tipo Salário"), "t")                      # a vintage may lack it
    estab = fx.raw_estab_layouts(spark, sf)[0].select("ano", "MUNICIPIO", "UF", "ESTOQUE")
    with pytest.raises(ValueError, match="nat_jur"):
        flows.standardize_estab(estab, "t", dims.activity_dimension(spark, ["0112101"]), dims.size_dimension(spark))


def test_gdp_growth_needs_the_year_before_and_population_one_row(spark):
    from regstat.plans import analyses
    gdp = spark.createDataFrame([(2018, 1, 10.0), (2021, 1, 20.0), (2022, 1, 30.0)], "ano long, id_municipio long, pib_corrente double")
    assert {r["ano"]: r["crescimento"] for r in analyses.gdp_growth(gdp).collect()} == {2018: None, 2021: None, 2022: 0.5}
    pop = spark.createDataFrame([(1, 2018, 5), (1, 2021, 8)], "id_municipio long, ano long, populacao long")
    got = {r["ano"]: r["pib_per_capita"] for r in analyses.gdp_per_capita(gdp, pop).collect()}
    assert got == {2018: 2000.0, 2021: 2500.0, 2022: None}
    with pytest.raises(ValueError, match="several rows"):
        analyses.gdp_per_capita(gdp, pop.unionByName(pop))


def test_dimension_types_follow_the_values(spark):
    from regstat.plans import flows
    df = spark.createDataFrame([("1", " a", "01", "70000"), ("32766", "bcd", "2", "-5")], "c string, d string, z string, n string")
    typed, types = flows.typed_dimension(df, "own", "2024-01-31")
    assert types == {"c": "smallint", "d": "varchar(3)", "z": "varchar(2)", "n": "int", "curr_date": "varchar(10)", "ds_owner": "varchar(3)"}
    assert dict(typed.dtypes)["c"] == "smallint" and typed.count() == 2


def _vintage_expected(target, year, src):
    """Appendix A written out as a table lookup (the property the rule table must meet)."""
    if target.startswith("vl_rem_") and target.endswith("_cc"):
        return 0.0 if year < 2015 else (src["cc"] if year < 2020 else src["sc"])
    return {
        "ano_chegada_brasil": "1900" if year < 2016 else src["text"],
        "ind_trab_parcial": "-1" if year < 2017 else src["text"],
        "tipo_salario": src["text"] if year == 2018 else "-1",
        "ibge_subsetor": "-1" if year < 2015 else src["text"],
        "vl_salario_contratual": src["money"] if year == 2018 else 0.0,
    }[target]


@pytest.mark.parametrize("year", list(range(2010, 2024)))
def test_links_vintage_matrix(spark, year):
    row = {"ano": year, "vl_rem_maio_cc": "10,5", "vl_rem_maio_sc": "20,25", "ano_chegada_brasil": "1988",
           "ind_trab_parcial": "1", "tipo_salario": "3", "ibge_subsetor": "7", "vl_salario_contratual": "99,9",
           "bairros_sp": "{ñ class}"}
    needed = {r.source for rules in vintage.links_rules().values() for r in rules if r.source} - set(schemas.LINKS_MAY_LACK)
    df = spark.createDataFrame([row]).select("*", *[F.lit(None).cast("string").alias(c) for c in sorted(needed - set(row))])
    r = one(vintage.harmonize_links(df, "ano"))
    src = {"cc": 10.5, "sc": 20.25, "text": None, "money": 99.9}
    assert r["vl_rem_maio_cc"] == _vintage_expected("vl_rem_maio_cc", year, src)
    assert r["vl_rem_janeiro_cc"] == (0.0 if year < 2015 else None)      # absent source column
    for t, v in [("ano_chegada_brasil", "1988"), ("ind_trab_parcial", "1"), ("tipo_salario", "3"),
                 ("ibge_subsetor", "7")]:
        assert r[t] == _vintage_expected(t, year, dict(src, text=v))
    assert r["vl_salario_contratual"] == _vintage_expected("vl_salario_contratual", year, src)
    # '{ñ c' before 2016 leaves '-1lass}' → NULL, the long pattern gives -1
    assert r["bairros_sp"] == (None if year <= 2015 else -1)


def test_harmonize_estab_switch(spark):
    df = spark.createDataFrame([(2013, "123", "4", "CNPJ"), (2014, "123", "4", "CNPJ")],
                               "ano int, cep string, subsetor_ibge string, ctg_tipo_estab string")
    rows = {r["ano"]: r for r in vintage.harmonize_estab(df).collect()}
    assert (rows[2013]["cep"], rows[2013]["subsetor_ibge"]) == ("-1", "-1")    # D16: overwritten
    assert (rows[2014]["cep"], rows[2014]["subsetor_ibge"]) == ("123", "4")
    assert "ctg_tipo_estab" not in vintage.harmonize_estab(df).columns


def test_activity_dimension_rule():
    rows = {c: (i, s) for c, i, s in dims.activity_rows(["0112101", "4120400", "4110700", "8430200", "9900800"])}
    assert rows["0112101"] == (dims.AGRO, "Agropecuária")
    assert rows["4120400"] == (dims.CONSTRUCAO, "Construção Civil")      # exception
    assert rows["4110700"] == (dims.SERVICOS, "Serviços")                # division 41 default
    assert rows["8430200"] == (dims.SERVICOS, "Serviços")
    assert rows["9999999"] == ("-1", "-1") and rows["-1"] == ("-1", "-1")
    assert len(dims.size_rows()) == 99


def test_activity_dimension_from_frame_matches_list(spark):
    codes = fx.fixture_codes()
    a = dims.activity_dimension(spark, codes)
    b = dims.activity_dimension(spark, spark.createDataFrame([(c,) for c in codes], "cnae_2_subclasse string"))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_lookup_unlisted_code_is_unknown(spark):
    act = dims.activity_dimension(spark, ["0112101"])
    df = spark.createDataFrame([("0112101",), ("0112199",), ("-1",)], "cnae_2_subclasse string")
    got = {r[0]: r[1] for r in classify.add_sectors(df, act).select("cnae_2_subclasse", "setor_ibge").collect()}
    assert got == {"0112101": dims.AGRO, "0112199": "-1", "-1": "-1"}     # hard point 5


def test_only_fixed_lists_are_broadcast_by_force(spark):
    frame = spark.range(10).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v"))
    assert not classify.fits_broadcast(frame)
    assert classify.fits_broadcast(dims.bounded(frame, 10), max_rows=10)
    assert not classify.fits_broadcast(dims.bounded(frame, 10), max_rows=9)


def test_integer_code_list_is_padded(spark):
    codes = spark.createDataFrame([(111301,), (4711302,)], "cnae_2_subclasse int")
    got = {r["cnae_2_subclasse"]: r["setor_ibge"] for r in dims.activity_dimension(spark, codes).collect()}
    assert got["0111301"] == dims.AGRO and got["4711302"] == dims.COMERCIO


def test_porte_matrix(spark):
    size = dims.size_dimension(spark)
    df = spark.createDataFrame([(dims.COMERCIO, "6"), (dims.TRANSFORMACAO, "6"), (dims.ADM_PUBLICA, "-1"),
                                (dims.SERVICOS, "0"), ("-1", "3")], "setor_ibge string, tam_estab string")
    got = [r["porte_sebrae"] for r in classify.add_porte(df, size).collect()]
    assert sorted(got) == sorted(["Média", "Pequena", "Não se aplica", "-1", "-1"])


def test_enterprise_flag(spark):
    df = spark.createDataFrame([("0990401", "2062"), ("4711301", "2062"), ("8411600", "2062"), ("4711301", "1031")],
                               "cnae_2_subclasse string, nat_jur string")
    flags = [r[0] for r in df.select(classify.enterprise_flag_col()).collect()]
    assert flags == [0, 1, 0, 0]


def test_profiles_one_pass(spark):
    df = spark.createDataFrame([(1, None, "a"), (-1, 5, None), (-1, -1, "bb")], "a int, b int, c string")
    nulls = {r[0]: r[1] for r in profile.null_profile(df).collect()}
    assert nulls == {"a": 0, "b": 1, "c": 1}
    minus = {r[0]: r[1] for r in profile.sentinel_profile(df).collect()}
    assert minus == {"a": 2, "b": 1}
    types = {r["coluna"]: r["tipo"] for r in profile.infer_narrow_types(df).collect()}
    assert types == {"a": "smallint", "b": "smallint", "c": "varchar(2)"}
    big = spark.createDataFrame([(32767,), (2147483647,)], "x long")
    assert one(profile.infer_narrow_types(big))["tipo"] == "bigint"      # strict '<' bounds
    prof = {r["coluna"]: (r["max_valor"], r["max_len"], r["n_distintos"])
            for r in profile.column_profile(df).collect()}
    assert prof["c"] == ("bb", 2, 2)


def test_infer_types_min_option(spark):
    df = spark.createDataFrame([(5,), (-40000,)], "x int")
    assert one(profile.infer_narrow_types(df))["tipo"] == "smallint"          # the reference looks at max only
    assert one(profile.infer_narrow_types(df, use_min=True))["tipo"] == "int"


def test_by_uf_fills_null_state_first(spark):
    df = spark.createDataFrame([("SP", 1), (None, 2), ("NI", 3), ("MG", 4)], "uf string, v int")
    assert sorted(r["v"] for r in shape.by_uf(df, "NI").collect()) == [2, 3]
    assert [r["v"] for r in shape.by_uf(df, "SP").collect()] == [1]


def test_rename_by_dict_follows_spark_name_matching(spark):
    df = spark.createDataFrame([(1, 2)], "Uf int, `Município` int")
    mapping = {"UF": "sigla_uf", "Município": "id_municipio"}
    assert shape.rename_by_dict(df, mapping).columns == ["sigla_uf", "id_municipio"]
    assert shape.rename_by_dict(df, mapping, case_sensitive=True).columns == ["Uf", "id_municipio"]
