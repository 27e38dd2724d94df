"""Extract 1: members with chronic-condition lists, masked.

One function per step; each returns a lazy DataFrame. ``build`` wires them.
Shuffles: the repeat count (member, diagnosis, group), the first-date
aggregate, the aligned lists (member), the joins onto the premium table (unit
id, then member id - consecutive joins on one key reuse one partitioning),
the 22-key group and one final DISTINCT.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimweave import functions as cf
from claimweave import operators as op
from claimweave.params import (CANONICAL_PLACE, DEFAULT_PLACE_CODE, DEPARTMENT_ALIAS, END_DATE_SENTINEL,
                               PROVINCE_ALIAS, SEX_CODES, UNKNOWN_PLACE, MembersParams)
from claimweave.sources.sinks import Stager
from claimweave.sources.sinks import stage as stage_table

MEMBER = "id_persona_afiliado"
DX = "num_diagnostico_origen"

# Nested claim fields this job reads: (claim, care event, procedure).
CLAIM_FIELDS = (["periodo", "id_siniestro", MEMBER, "fec_hora_ocurrencia"],
                [DX, "id_cobertura_origen"], [])


@dataclass(frozen=True)
class MembersInputs:
    claims: DataFrame          # nested claims (schemas.CLAIMS)
    dx_groups: DataFrame       # diagnosis -> risk group
    persons: DataFrame         # persons with identity documents
    addresses: DataFrame       # address snapshots
    departments: DataFrame
    provinces: DataFrame
    premiums: DataFrame        # premium snapshots with log month
    movements: DataFrame       # insurable-unit movements


# ---------------------------------------------------------------- chronic conditions

def _in_window(p: MembersParams):
    return F.col("fec_hora_ocurrencia").between(cf.ts_ntz(p.chronic_from), cf.ts_ntz(p.chronic_to))


def _after_first_year(p: MembersParams):
    return F.col("fec_hora_ocurrencia") >= cf.ts_ntz(f"{p.first_year_after + 1}-01-01")


def claim_events(claims: DataFrame, p: MembersParams, stage: Stager | None = stage_table) -> DataFrame:
    """The claims snapshot exploded once to (claim, member, time, diagnosis, cover).

    Both chronic-condition steps read it (the analysis window and the
    first-date lookup); with ``stage`` the nested snapshot is scanned and
    exploded once, and the narrow rows are written to the shared folder.
    """
    c = op.snapshot(claims, p.claims_snapshot).where(_in_window(p) | _after_first_year(p))
    ev = op.explode_rows(c.select("fec_hora_ocurrencia", "id_siniestro", MEMBER, "atencion_salud"),
                         "atencion_salud", "sd")
    flat = ev.select("fec_hora_ocurrencia", "id_siniestro", MEMBER, F.col(f"sd.{DX}").alias(DX),
                     F.col("sd.id_cobertura_origen").alias("id_cobertura_origen"))
    return stage(flat, "member_claim_events") if stage else flat


def claim_diagnoses(events: DataFrame, p: MembersParams, distinct: bool = True) -> DataFrame:
    """M1.2 ``siniestros``: distinct (claim, member, diagnosis, cover) in the window.

    ``distinct=False`` skips the DISTINCT where the only consumer is a
    distinct count of claims, which duplicates cannot change.
    """
    rows = events.where(_in_window(p)).select(
        "fec_hora_ocurrencia", "id_siniestro", MEMBER, DX, "id_cobertura_origen")
    return rows.distinct() if distinct else rows


def chronic_claims(claim_dx: DataFrame, dx_groups: DataFrame, p: MembersParams) -> DataFrame:
    """M1.3 ``base0``: attach the risk group, keep the chronic groups (left join + WHERE = inner)."""
    g = dx_groups.where(F.col("grupo_riesgo").isin(*p.risk_groups)).select(
        F.col(DX).alias("__dx"), "grupo_riesgo")
    return claim_dx.join(g, F.col(DX) == F.col("__dx"), "inner").drop("__dx")


def repeated_conditions(base0: DataFrame, p: MembersParams) -> DataFrame:
    """M1.4-M1.5: (member, diagnosis, group) seen on >= ``min_claims`` distinct claims."""
    return op.repeat_flag(base0, [MEMBER, DX, "grupo_riesgo"], "id_siniestro", p.min_claims).drop("cantidad")


def first_diagnosis_dates(events: DataFrame, p: MembersParams) -> DataFrame:
    """M1.6: earliest occurrence per (member, diagnosis), years after ``first_year_after``."""
    return (events.where(_after_first_year(p)).groupBy(MEMBER, DX)
            .agg(F.min("fec_hora_ocurrencia").alias("fecha_antiguedad")))


def chronic_lists(flags: DataFrame, first_dates: DataFrame) -> DataFrame:
    """M1.7-M1.8: per member, the diagnosis list and the aligned first-date list."""
    j = flags.join(first_dates, [MEMBER, DX], "left").withColumn(
        "fecha_antiguedad", F.col("fecha_antiguedad").cast("timestamp_ntz"))
    return op.aligned_lists(j, [MEMBER], DX, "fecha_antiguedad", ",",
                            "diag_h_2_cronicos", "fecha_antiguedad_dx")


def repeat_condition_members(inp: MembersInputs, p: MembersParams,
                             stage: Stager | None = stage_table) -> DataFrame:
    """Members with one chronic diagnosis on >= 2 claims, with first dates (M1.2-M1.8)."""
    events = claim_events(inp.claims, p, stage)
    # The claims DISTINCT of M1.2 only feeds COUNT(DISTINCT claim): skipped.
    base0 = chronic_claims(claim_diagnoses(events, p, distinct=False), inp.dx_groups, p)
    return chronic_lists(repeated_conditions(base0, p), first_diagnosis_dates(events, p))


# ---------------------------------------------------------------- people and places

def principal_documents(persons: DataFrame) -> DataFrame:
    """M1.9 ``persona``: names and the principal identity document."""
    ex = op.explode_rows(persons, "documento_identidad", "b")
    return ex.where(F.col("b.ind_documento_principal") == "1").select(
        "id_persona", "nom_corto",
        F.concat(F.col("ape_paterno"), F.lit(" "), F.col("ape_materno")).alias("apellidos"),
        F.col("b.num_documento").alias("num_documento"))


def tax_documents(persons: DataFrame) -> DataFrame:
    """M1.11 ``ruc``: tax documents."""
    ex = op.explode_rows(persons.select("id_persona", "documento_identidad"), "documento_identidad", "b")
    return ex.where(F.col("b.tip_documento") == "RUC").select(
        "id_persona", F.col("b.num_documento").alias("num_documento"))


def active_units(premiums: DataFrame, p: MembersParams) -> DataFrame:
    """M1.12 ``vig``: units in the premium snapshot of the log month, sentinel end date."""
    v = op.snapshot(premiums, p.premium_snapshot).where(F.col("periodo_bitacora") == F.lit(p.log_month))
    return (v.select("id_unidad_asegurable", MEMBER).distinct()
            .withColumn("fecha_de_baja", F.lit(END_DATE_SENTINEL)))


def unit_end_dates(movements: DataFrame, vig: DataFrame, p: MembersParams) -> DataFrame:
    """M1.13-M1.14: latest movement end date per unit.

    ``literal``: as written - a left join to ``vig`` filtered on
    ``fecha_de_baja <> sentinel`` keeps nothing (the constant equals itself,
    NULL never compares); Catalyst folds it to an empty relation.
    ``intended``: movements of units that are *not* active.
    """
    m = movements.select("id_unidad_asegurable", "fec_fin_movimiento")
    if p.end_date_mode == "literal":
        j = m.join(vig.select(F.col("id_unidad_asegurable").alias("__u"), "fecha_de_baja"),
                   F.col("id_unidad_asegurable") == F.col("__u"), "left")
        m = j.where(F.col("fecha_de_baja") != F.lit(END_DATE_SENTINEL)).select(*m.columns)
    elif p.end_date_mode == "intended":
        m = m.join(vig.select("id_unidad_asegurable"), "id_unidad_asegurable", "left_anti")
    else:
        raise ValueError(f"end_date_mode {p.end_date_mode!r}")
    return op.latest_value_per_key(m, ["id_unidad_asegurable"], "fec_fin_movimiento")


def place_names(addresses: DataFrame, p: MembersParams) -> DataFrame:
    """Principal, non-royal address of the latest snapshot <= bound (D3 with A4)."""
    latest = op.latest_snapshot(addresses, p.address_bound)
    return addresses.where((F.col("ind_principal") == 1) & (F.col("ind_royal") != "1")
                           & (F.col("periodo") == latest)).select(
        F.col("id_persona").alias("__addr_id"), "des_departamento", "des_provincia")


# ---------------------------------------------------------------- wide join and output

GROUP_COLS = [
    "codigo_entidad", "cod_producto_origen", "descripcion", "numero_afiliado", "fec_afiliacion_asegurado",
    "fecha_de_alta", "fecha_de_baja", "nom_corto", "apellidos", "ruc", "num_documento", "fecha_nacimiento",
    "des_sexo_afiliado", "des_departamento_gestion_servicio_asegurado",
    "des_provincia_gestion_servicio_asegurado", "id_poliza", "num_poliza", "des_producto_agrupado",
    "TIPO_AFILIACION", "mnt_prima_neta_inducida_afiliado_sol", "dia_cronicos_regla_negocio_adicional",
    "fecha_antiguedad_dx"]


def member_rows(inp: MembersInputs, p: MembersParams, lists: DataFrame) -> DataFrame:
    """M1.15 ``resultado``: premium rows + 7 left joins, grouped on 22 outputs."""
    vig = active_units(inp.premiums, p)
    a = (op.snapshot(inp.premiums, p.premium_snapshot)
         .where((F.col("periodo_bitacora") >= F.lit(p.log_since))
                & (F.col("des_producto_agrupado") == p.product_line)))
    bb = vig.select(F.col("id_unidad_asegurable").alias("__bb_unit"), F.col("fecha_de_baja").alias("__bb_baja"))
    cc = unit_end_dates(inp.movements, vig, p).select(F.col("id_unidad_asegurable").alias("__cc_unit"),
                                                      "fec_fin_movimiento")
    b = principal_documents(inp.persons).withColumnRenamed("id_persona", "__b_id")
    i = tax_documents(inp.persons).select(F.col("id_persona").alias("__i_id"), F.col("num_documento").alias("ruc"))
    j = lists.select(F.col(MEMBER).alias("__j_id"), "diag_h_2_cronicos", "fecha_antiguedad_dx")
    c = place_names(inp.addresses, p)

    x, salts = a, {}
    for right, key, own in ((bb, "id_unidad_asegurable", "__bb_unit"), (cc, "id_unidad_asegurable", "__cc_unit"),
                            (b, MEMBER, "__b_id"), (c, MEMBER, "__addr_id"), (i, MEMBER, "__i_id"), (j, MEMBER, "__j_id")):
        if p.salt_heavy:
            # One sketch a key of the premium rows, which all joins on it share.
            if key not in salts:
                salts[key] = op.heavy_keys(a, key, int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")))
            x = op.salted_join(x, right, key, own, "left", salts[key])
        else:
            x = x.join(right, F.col(key) == F.col(own), "left")
    # Department / province dimension joins of the reference add no column
    # and no row before this GROUP BY; they are left out.
    e = p.entity
    projected = x.select(
        F.lit(e.code).cast("bigint").alias("codigo_entidad"), "cod_producto_origen",
        F.lit(e.name).alias("descripcion"), F.col(MEMBER).alias("numero_afiliado"), "fec_afiliacion_asegurado",
        F.col("fec_afiliacion_asegurado").cast("timestamp_ntz").alias("fecha_de_alta"),
        op.join_hit("id_unidad_asegurable", "__bb_unit", F.col("__bb_baja").cast("string"),
                    F.col("fec_fin_movimiento").cast("string")).alias("fecha_de_baja"),
        "nom_corto", "apellidos", "ruc", "num_documento",
        F.col("fec_nacimiento_afiliado").cast("timestamp_ntz").alias("fecha_nacimiento"),
        cf.trim_ws("des_sexo_afiliado").alias("des_sexo_afiliado"),
        cf.normalise_place("des_departamento", [DEPARTMENT_ALIAS], CANONICAL_PLACE, UNKNOWN_PLACE)
        .alias("des_departamento_gestion_servicio_asegurado"),
        cf.normalise_place("des_provincia", [PROVINCE_ALIAS], CANONICAL_PLACE, UNKNOWN_PLACE)
        .alias("des_provincia_gestion_servicio_asegurado"),
        "id_poliza", "num_poliza", "des_producto_agrupado",
        F.when(F.col("id_producto") == p.individual_product, "NG").otherwise("G").alias("TIPO_AFILIACION"),
        "mnt_prima_neta_inducida_afiliado_sol",
        F.col("diag_h_2_cronicos").alias("dia_cronicos_regla_negocio_adicional"), "fecha_antiguedad_dx",
        "periodo_bitacora")
    g = projected.groupBy(*GROUP_COLS).agg(F.min("periodo_bitacora").alias("__min_log"))
    return g.withColumn("periodo_afiliacion", cf.earlier_of("fec_afiliacion_asegurado", "__min_log")).drop("__min_log")


OUTPUT_COLS = [
    "codigo_entidad", "descripcion", "numero_afiliado", "periodo_afiliacion", "fecha_de_alta", "fecha_de_baja",
    "nom_corto", "apellidos", "ruc", "num_documento", "fecha_nacimiento", "des_sexo_afiliado",
    "cod_departamento", "des_departamento_gestion_servicio_asegurado", "cod_provincia",
    "des_provincia_gestion_servicio_asegurado", "id_poliza", "num_poliza", "TIPO_AFILIACION",
    "mnt_prima_neta_inducida_afiliado_sol", "dx_cronicos_relacionados", "fecha_antiguedad_dx_afiliado"]


def members_extract(inp: MembersInputs, p: MembersParams, stage: Stager | None = stage_table) -> DataFrame:
    """M1.16-M1.18: recode, place codes by name, formats, masking (22 columns)."""
    rows = member_rows(inp, p, repeat_condition_members(inp, p, stage))
    dept = inp.departments.select("cod_departamento", "descripcion").distinct()
    prov = inp.provinces.select("cod_provincia", "descripcion").distinct()
    f = op.lookup_code(rows, dept, "des_departamento_gestion_servicio_asegurado", "descripcion",
                       "cod_departamento", "cod_departamento", None)
    f = op.lookup_code(f, prov, "des_provincia_gestion_servicio_asegurado", "descripcion",
                       "cod_provincia", "cod_provincia", None)
    ym = cf.fmt_yyyymm("periodo_afiliacion")
    # ``final`` and ``tablafin`` are both DISTINCT; one DISTINCT after the
    # projection gives the same set (distinct(f(distinct(x))) = distinct(f(x))).
    tabla = f.select(
        "codigo_entidad", "descripcion", "numero_afiliado",
        F.concat(F.substring(ym, 0, 4), F.lit("-"), F.substring(ym, 5, 2)).alias("periodo_afiliacion"),
        "fecha_de_alta", "fecha_de_baja", "nom_corto", "apellidos",
        F.coalesce(F.col("ruc").cast("string"), F.lit("0")).alias("ruc"), "num_documento", "fecha_nacimiento",
        cf.recode("des_sexo_afiliado", SEX_CODES, "I").alias("des_sexo_afiliado"),
        "cod_departamento", "des_departamento_gestion_servicio_asegurado", "cod_provincia",
        "des_provincia_gestion_servicio_asegurado", "id_poliza", "num_poliza", "des_producto_agrupado",
        "TIPO_AFILIACION", "mnt_prima_neta_inducida_afiliado_sol",
        F.col("dia_cronicos_regla_negocio_adicional").alias("dx_cronicos_relacionados"),
        F.col("fecha_antiguedad_dx").alias("fecha_antiguedad_dx_afiliado")).distinct()
    # ``finn``: masking and sentinels, no DISTINCT (masking may create duplicates).
    finn = tabla.select(
        "codigo_entidad", "descripcion", "numero_afiliado", "periodo_afiliacion", "fecha_de_alta",
        F.col("fecha_de_baja").cast("timestamp_ntz").alias("fecha_de_baja"), "nom_corto", "apellidos", "ruc",
        "num_documento", "fecha_nacimiento", "des_sexo_afiliado",
        F.coalesce("cod_departamento", F.lit(DEFAULT_PLACE_CODE).cast("bigint")).alias("cod_departamento"),
        "des_departamento_gestion_servicio_asegurado",
        F.coalesce("cod_provincia", F.lit(DEFAULT_PLACE_CODE).cast("bigint")).alias("cod_provincia"),
        "des_provincia_gestion_servicio_asegurado", "id_poliza", "num_poliza", "TIPO_AFILIACION",
        F.coalesce("mnt_prima_neta_inducida_afiliado_sol", F.lit(0.0)).alias("mnt_prima_neta_inducida_afiliado_sol"),
        "dx_cronicos_relacionados", "fecha_antiguedad_dx_afiliado")
    return op.mask(finn, constants={"nom_corto": ".", "apellidos": "."},
                   copies={"ruc": "numero_afiliado", "num_documento": "numero_afiliado"})


def members_count(inp: MembersInputs, p: MembersParams, stage: Stager | None = stage_table) -> DataFrame:
    """M1.19: number of distinct members in the extract."""
    return members_extract(inp, p, stage).agg(F.count_distinct("numero_afiliado").alias("n_afiliados"))
