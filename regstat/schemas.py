"""SNK-06: the three fixed target schemas (data contract, names kept in Portuguese).

Fixed values: column names, order and types of the three warehouse tables.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L = T.ShortType(), T.IntegerType(), T.LongType()
_D, _STR, _DATE = T.DoubleType(), T.StringType(), T.DateType()
MONEY = T.DecimalType(15, 2)


def _struct(pairs) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


# Municipal GDP table, 21 columns in table order.
SCHEMA_GDP = _struct([
    ("ano", _L), ("codigo_grande_regiao", _L), ("nome_grande_regiao", _STR),
    ("codigo_uf", _L), ("sigla_uf", _STR), ("nome_uf", _STR),
    ("id_municipio", _L), ("nome_municipio", _STR),
    ("vab_agropecuaria", _D), ("vab_industria", _D), ("vab_servicos", _D),
    ("vab_servicos_publicos", _D), ("vab_total", _D),
    ("impostos_liquidos_sobre_produtos", _D), ("pib_corrente", _D),
    ("pib_per_capita_corrente", _D), ("curr_date", _STR), ("ds_owner", _STR),
    ("atividade_principal_vab", _STR), ("atividade_2_vab", _STR), ("atividade_3_vab", _STR),
])

# Establishments table, 30 columns in table order.
SCHEMA_ESTAB_TABLE = _struct([
    ("ano", _S), ("sigla_uf", _S), ("id_municipio", _I), ("qtd_vinc_ativos", _I),
    ("qtd_vinc_clt", _I), ("qtd_vinc_estat", _I), ("nat_jur", _S), ("tam_estab", _S),
    ("tipo_estab", _S), ("ind_ativ_ano", _S), ("ind_cei_vinculado", _S), ("ind_pat", _S),
    ("ind_rais_negativa", _S), ("ind_simples", _S), ("cnae_1_classe", _I),
    ("cnae_2_classe", _I), ("cnae_2_subclasse", _I), ("subsetor_ibge", _I), ("cep", _I),
    ("bairro_sp", _S), ("bairro_fortaleza", _S), ("bairro_rj", _S), ("distrito_sp", _S),
    ("regiao_adm_df", _S), ("padrao_sebrae", _S), ("porte_sebrae", _STR),
    ("setor_sebrae", _STR), ("setor_ibge", _STR), ("ds_owner", _STR), ("curr_date", _STR),
])

# Order in which the establishment transform hands its 30 columns over.
ESTAB_OUTPUT_ORDER = [
    "ds_owner", "curr_date", "ano", "sigla_uf", "id_municipio", "qtd_vinc_ativos",
    "qtd_vinc_clt", "qtd_vinc_estat", "nat_jur", "tam_estab", "tipo_estab", "ind_ativ_ano",
    "ind_cei_vinculado", "ind_pat", "ind_rais_negativa", "ind_simples", "cnae_1_classe",
    "cnae_2_classe", "cnae_2_subclasse", "subsetor_ibge", "cep", "bairro_sp",
    "bairro_fortaleza", "bairro_rj", "distrito_sp", "regiao_adm_df", "padrao_sebrae",
    "porte_sebrae", "setor_sebrae", "setor_ibge",
]

# Employment-links table, 65 columns in table order.
SCHEMA_LINKS = _struct([
    ("bairros_fortaleza", _S), ("bairros_rj", _S), ("causa_afastamento_1", _S),
    ("causa_afastamento_2", _S), ("causa_afastamento_3", _S), ("motivo_desligamento", _S),
    ("cbo_ocupacao_2002", _I), ("cnae_2_0_classe", _I), ("cnae_95_classe", _I),
    ("distritos_sp", _S), ("vinculo_ativo_31_12", _S), ("faixa_etaria", _S),
    ("faixa_hora_contrat", _S), ("faixa_remun_dezem_sm", _S), ("faixa_remun_media_sm", _S),
    ("faixa_tempo_emprego", _S), ("escolaridade_apos_2005", _S), ("qtd_hora_contr", _S),
    ("idade", _S), ("ind_cei_vinculado", _S), ("ind_simples", _S), ("mes_admissao", _S),
    ("mes_desligamento", _S), ("mun_trab", _I), ("municipio", _I), ("nacionalidade", _S),
    ("natureza_juridica", _S), ("ind_portador_defic", _S), ("qtd_dias_afastamento", _S),
    ("raca_cor", _S), ("regioes_adm_df", _S), ("vl_remun_dezembro_nom", MONEY),
    ("vl_remun_dezembro_sm", MONEY), ("vl_remun_media_nom", MONEY),
    ("vl_remun_media_sm", MONEY), ("cnae_2_0_subclasse", _I), ("sexo_trabalhador", _S),
    ("tamanho_estabelecimento", _S), ("tempo_emprego", _S), ("tipo_admissao", _S),
    ("tipo_estab", _S), ("tipo_estab_dsc", _STR), ("tipo_defic", _S), ("tipo_vinculo", _S),
    ("ibge_subsetor", _S), ("vl_rem_janeiro_cc", MONEY), ("vl_rem_fevereiro_cc", MONEY),
    ("vl_rem_marco_cc", MONEY), ("vl_rem_abril_cc", MONEY), ("vl_rem_maio_cc", MONEY),
    ("vl_rem_junho_cc", MONEY), ("vl_rem_julho_cc", MONEY), ("vl_rem_agosto_cc", MONEY),
    ("vl_rem_setembro_cc", MONEY), ("vl_rem_outubro_cc", MONEY),
    ("vl_rem_novembro_cc", MONEY), ("ano_chegada_brasil", _S),
    ("ind_trab_intermitente", _S), ("ind_trab_parcial", _S), ("tipo_salario", _S),
    ("vl_salario_contratual", MONEY), ("uf", _STR), ("ano", _S), ("curr_date", _DATE),
    ("ds_owner", _STR),
])


def sql_type(dt: T.DataType) -> str:
    """Spark type → the SQL type name both Spark and DuckDB accept in a cast."""
    if isinstance(dt, T.ShortType):
        return "smallint"
    if isinstance(dt, T.IntegerType):
        return "int"
    if isinstance(dt, T.LongType):
        return "bigint"
    if isinstance(dt, T.DoubleType):
        return "double"
    if isinstance(dt, T.DecimalType):
        return f"decimal({dt.precision},{dt.scale})"
    if isinstance(dt, T.DateType):
        return "date"
    return "string"

# Establishment header dictionary (both layouts) → target names.
ESTAB_HEADERS = {
    "BAIRRO_SP": "bairro_sp",
    "BAIRRO FORT": "bairro_fortaleza",
    "BAIRRO_RJ": "bairro_rj",
    "CLAS CNAE 20": "cnae_2_classe",
    "CLAS CNAE 95": "cnae_1_classe",
    "DISTRITO_SP": "distrito_sp",
    "EST CLT OUT": "qtd_vinc_clt",
    "ESTOQUE": "qtd_vinc_ativos",
    "ESTOQUE ESTA": "qtd_vinc_estat",
    "IND ATIV ANO": "ind_ativ_ano",
    "IND CEI VINC": "ind_cei_vinculado",
    "IND PAT": "ind_pat",
    "IND RAIS NEG": "ind_rais_negativa",
    "IND SIMPLES": "ind_simples",
    "MUNICIPIO": "id_municipio",
    "NAT JURIDICA": "nat_jur",
    "REG ADM DF": "regiao_adm_df",
    "SB CLAS 20": "cnae_2_subclasse",
    "TAMESTAB": "tam_estab",
    "TIPO ESTBL": "tipo_estab",
    "UF": "sigla_uf",
    "IBGE Subsetor": "subsetor_ibge",
    "Bairros SP": "bairro_sp",
    "Bairros Fortaleza": "bairro_fortaleza",
    "Bairros RJ": "bairro_rj",
    "CNAE 2.0 Classe": "cnae_2_classe",
    "CNAE 95 Classe": "cnae_1_classe",
    "Distritos SP": "distrito_sp",
    "Qtd Vínculos CLT": "qtd_vinc_clt",
    "Qtd Vínculos Ativos": "qtd_vinc_ativos",
    "Qtd Vínculos Estatutários": "qtd_vinc_estat",
    "Ind Atividade Ano": "ind_ativ_ano",
    "Ind CEI Vinculado": "ind_cei_vinculado",
    "Ind Estab Participa PAT": "ind_pat",
    "Ind Rais Negativa": "ind_rais_negativa",
    "Ind Simples": "ind_simples",
    "Município": "id_municipio",
    "Natureza Jurídica": "nat_jur",
    "Regiões Adm DF": "regiao_adm_df",
    "CNAE 2.0 Subclasse": "cnae_2_subclasse",
    "Tamanho Estabelecimento": "tam_estab",
    "Tipo Estab": "tipo_estab",
    "Tipo Estab.1": "ctg_tipo_estab",
    "Tipo Estab19": "tipo_estab",
    "Tipo Estab20": "ctg_tipo_estab",
    "CEP Estab": "cep",
    "CEP Estb": "cep",
}

# The 24 workbook columns the GDP load drops.
GDP_DROP = ["Região Metropolitana", "Código da Mesorregião", "Nome da Mesorregião",
            "Código da Microrregião", "Nome da Microrregião", "Código da Região Geográfica Imediata",
            "Nome da Região Geográfica Imediata", "Município da Região Geográfica Imediata",
            "Código da Região Geográfica Intermediária", "Nome da Região Geográfica Intermediária",
            "Município da Região Geográfica Intermediária", "Código Concentração Urbana",
            "Nome Concentração Urbana", "Tipo Concentração Urbana", "Código Arranjo Populacional",
            "Nome Arranjo Populacional", "Hierarquia Urbana", "Hierarquia Urbana (principais categorias)",
            "Código da Região Rural", "Nome da Região Rural", "Região rural (segundo classificação do núcleo)",
            "Amazônia Legal", "Semiárido", "Cidade-Região de São Paulo"]

# Workbook header → GDP table column.
GDP_HEADERS = {
    "Ano": "ano",
    "Código da Grande Região": "codigo_grande_regiao",
    "Nome da Grande Região": "nome_grande_regiao",
    "Código da Unidade da Federação": "codigo_uf",
    "Sigla da Unidade da Federação": "sigla_uf",
    "Nome da Unidade da Federação": "nome_uf",
    "Código do Município": "id_municipio",
    "Nome do Município": "nome_municipio",
    "Valor adicionado bruto da Agropecuária, \na preços correntes\n(R$ 1.000)": "vab_agropecuaria",
    "Valor adicionado bruto da Indústria,\na preços correntes\n(R$ 1.000)": "vab_industria",
    "Valor adicionado bruto dos Serviços,\na preços correntes \n- exceto Administração, defesa, educação e saúde públicas e seguridade social\n(R$ 1.000)": "vab_servicos",
    "Valor adicionado bruto da Administração, defesa, educação e saúde públicas e seguridade social, \na preços correntes\n(R$ 1.000)": "vab_servicos_publicos",
    "Valor adicionado bruto total, \na preços correntes\n(R$ 1.000)": "vab_total",
    "Impostos, líquidos de subsídios, sobre produtos, \na preços correntes\n(R$ 1.000)": "impostos_liquidos_sobre_produtos",
    "Produto Interno Bruto, \na preços correntes\n(R$ 1.000)": "pib_corrente",
    "Produto Interno Bruto per capita, \na preços correntes\n(R$ 1,00)": "pib_per_capita_corrente",
    "Atividade com maior valor adicionado bruto": "atividade_principal_vab",
    "Atividade com segundo maior valor adicionado bruto": "atividade_2_vab",
    "Atividade com terceiro maior valor adicionado bruto": "atividade_3_vab",
}

# Columns that a layout may lack, by vintage; any other absence is an error.
ESTAB_MAY_LACK = ("cep", "subsetor_ibge")
GDP_MAY_LACK = ("atividade_3_vab",)
LINKS_MAY_LACK = ("ano_chegada_brasil", "ind_trab_parcial", "ind_trab_intermitente", "tipo_salario", "ibge_subsetor", "vl_salario_contratual",
                  *(f"vl_rem_{m}_{kind}" for m in ("janeiro", "fevereiro", "marco", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro",
                                                    "novembro") for kind in ("cc", "sc")))


def require(columns, present, may_lack=()) -> None:
    """Raise, naming them, for columns that are neither there nor allowed to be absent."""
    missing = sorted(set(columns) - set(present) - set(may_lack))
    if missing:
        raise ValueError(f"columns not found: {missing}")
