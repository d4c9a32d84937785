"""The 23 reports as data: delivered layouts, load rules and ingestion sources.

Layout text: one column per ``|`` item, ``NAME type [ymd|dmy|iso] [?] [>HEADER]``
(``ymd`` = yyyy/MM/dd, ``dmy`` = dd/MM/yyyy, ``iso`` = yyyy-MM-dd, ``?`` nullable,
``>HEADER`` delivered header). ``text`` / ``number`` mark reports whose table has
no declared DDL (kind taken from sample values; ``number`` is decimal(18,6)).
"""

from __future__ import annotations

from periodica.functions.periods import DAILY, MONTHLY, WEEKLY
from periodica.spec import (ID_COL, LOAD_TS_COL, IngestSpec, LayoutColumn,
                            ReportSpec, parse_layout)

# --- Fixed values: delivered layouts (names, declared types, order, date forms),
# --- as the regulator's file layouts require them. ---------------------------
LAYOUTS = {
    21: "NUM_ID varchar(34) | FE_CON_OPE date ymd | FE_VEN_FLU_R date ymd | FE_VEN_FLU_E date ymd | ACT_OPE numeric(15,0) | MON_ACT_OPE varchar(3) | ACT_OPE_ME numeric(15,0) | MON_ACT_OPE_ME varchar(3) | PAS_OPE numeric(15,0) | MON_PAS_OPE varchar(3) | PAS_OPE_MR numeric(15,0) | MON_PAS_OPE_MR varchar(3) | DUR_ACT numeric(15,0) | DUR_PAS numeric(15,0) | ID_GAR varchar(20) | NOCIONAL numeric(15,0) | MON_NOCIONAL varchar(3) | FECHAINFO date ymd",
    50: "CONTRATO varchar(50) | NOMBRE varchar(50) | IMPORTE numeric(18,6) | MONEDA varchar(3) | CLAVE_BAN varchar(6) >CLAVE_BANXICO",
    75: "TITULOOBJETO text | NUMEROTITULOS number | CONTRAPARTE text | MONEDA text | PRECIOUNITARIO number | PRECIO_VAL_MERCADO number | CLASIFICACIONCONTABLE text | POSICIONOPERACION text | CVETIPOINSTRUMENTO text | OFICINA text | DEPOSITADOENGARANTIA number",
    76: "FECHACONCERTACION date ymd | HORACONCERTACION numeric(5,2) | POSICIONOPERACION varchar(1) | FECHAINICIO date ymd | FECHAVENCIMIENTO date ymd | IMPORTEREPORTO numeric(12,0) | MONEDAPRECIOUNITARIO varchar(3) | TASAPREMIO numeric(8,4) | TITULOOBJETOREPORTO varchar(18) | PRECIOUNITARIOTITULOS numeric(19,8) | NUMEROTITULOSOBJETOREPORTO numeric(12,0) | CONTRAPARTEREPORTO varchar(6) | RESIDENCIA_CONTRAPARTE varchar(3) | PROPIA_TERCEROS varchar(1) | CLIENTE_PROV varchar(6) | CORROELECTRONICO numeric(2,0) | TIPOPOSTURA varchar(2) | OPERACIONBANCOTRABAJO varchar(1) | HAIRCUT numeric(4,2) | REP_SUSTITUCION varchar(1) | MODALIDAD_REPORTO varchar(2) | PLAZO_EVERGREEN numeric(3,0) | REP_CONJUNTO_VAL varchar(1) | REP_AG_TRIPARTITO varchar(1) | AGENTE_TRIPARTITO varchar(6) | TASA_REFERENCIA_PREMIO numeric(3,0) | SOBRETASA_PREMIO numeric(8,4) | PERIODO_PAGO_PREMIO numeric(6,0) | NUMEROIDENTIFICACIONOPERACION varchar(37) | CLASIFICACIONCONTABLEOPERACION varchar(2) | FECHAVENCIMIENTO_TITULO date ymd | OFICINA varchar(1) | EMISION varchar(50) | SERIE varchar(50) | TIPOVALOR varchar(50) | SOBRETASA varchar(1) | EMISOR varchar(6) | DIASXVENCER_CUPON numeric(12,0) | APLICA_ANEXO1C varchar(1) | CUSTODIO numeric(6,0) | FECHAVALOR numeric(1,0) | CLIENTE numeric(6,0) | RESTRICCION varchar(2) | FECHA_INFO date ymd ?",
    80: "INSTCUENTRANS text | FECHATRANS date ymd | TIPOTRANSCUST number | TITULOBJTRANS text | NUMTITULOS numeric(12,0) | CUSTCONTRAPARTE number | NUMIDTRANS text | TIPOMODIFICACION text | FECHA_INFO date ymd ?",
    81: "CLIENTEINSTITUCION text | FECHANOTIFICACIONTRANSFERENCIA date ymd | TIPOTRANSFERENCIACUSTODIA text | FECHATRANSFERENCIA date ymd | TITULOTRANSFERENCIA text | NUMEROTITULOS number | CUSTODIOCONTRAPARTE number | NUMEROIDENTIFICACIONTRANSFERENCIA text | TIPOMODIFICACION text | FECHA_INFO date ymd ?",
    83: "FECHACONCERTACION date ymd | NUMEROOPERACIONINCUMPLIDA text | SECCION number | FECHAREGISTROINCUMPLIMIENTO date ymd | TIPOINCUMPLIMIENTO number | NUMEROTITULOSINCUMPLIDOS number | NUMEROINCUMPLIMIENTO text | CAUSANTEINCUMPLIMIENTO text | RAZONINCUMPLIMIENTO text | TIPOMODIFICACION text | FECHA_INFO date ymd ?",
    84: "TITULOOBJETO varchar(18) | PRECIO_VAL_MERCADO numeric(19,8) | CLASIFICACION_CONTABLE varchar(2) | Restriccion varchar(2) | Custodio varchar(6) | FechaValor numeric(1,0) | Cliente varchar(6) | NoTitulosCliente numeric(12,0) | NoTitulosCedidos numeric(12,0) | NoTitulosGarantia numeric(12,0) | FECHA_INFO date ymd ?",
    93: "TIPOOPERACION numeric(2,0) | TIPOFONDEO numeric(2,0) | FECHA_INICIO date ymd | FECHA_VENC date ymd | MONTO_OPER numeric(12,0) | MONEDA varchar(3) | CVE_ACREEDOR varchar(18) | TIP_REL_ACREED numeric(2,0) | CVE_OPERACION varchar(34)",
    121: "FECHACONCERTACION date ymd | HORACONCERTACION number | POSICIONOPERACION text | FECHAINICIO date ymd | FECHAVENCIMIENTO date ymd | IMPORTEREPORTO number | MONEDAPRECIOUNITARIO text | TASAPREMIO number | TIPOTASAPREMIO varchar(1) | TITULOOBJETOREPORTO text | PRECIOUNITARIOTITULOS number | NUMEROTITULOSOBJETOREPORTO number | CONTRAPARTEREPORTO text | CORROELECTRONICO number | TIPOPOSTURA text | OPERACIONBANCOTRABAJO text | NUMEROIDENTIFICACIONOPERACION text | TIPOMODIFICACION varchar(1) | CLASIFICACIONCONTABLEOPERACION text | FECHAVENCIMIENTO_TITULO date ymd | OFICINA text | EMISION text | SERIE text | TIPOVALOR text | SOBRETASA number | EMISOR text | DIASXVENCER_CUPON number | APLICA_ANEXO1C number | CUSTODIO number >Custodio | FECHAVALOR number >FechaValor | CLIENTE number >Cliente | RESTRICCION text >Restriccion",
    122: "FECHACONCERTACION date ymd | TITULOOBJETOREPORTO varchar(18) | PRECIOUNITARIOTITULOS numeric(19,8) | NUMEROTITULOSOBJETOREPORTO numeric(12,0) | IMPORTEREPORTO numeric(12,0) | HAIRCUT numeric(4,2) | FECHA_FIN_COLATERAL date ymd | NUMEROIDENTIFICACIONOPERACION varchar(37) | NUM_ID_CANASTA varchar(37) | SECCION varchar(2) | EMISION varchar(50) ? | SERIE varchar(50) ? | TIPOVALOR varchar(50) ? | FECHA_INFO date ymd",
    132: "PRO_TER text | CLIENTE number | POS_OPER text | PIZARRA text | SOCIO_LIQ number | CONTRAT_VIG number | OBJ_OPE text | PAQ_FUT number | ID_PAQ text | CONSEQ_PAQ number | ACT_OPE number | MON_ACT_OPE text | PAS_OPE number | MON_PAS_OPE text | DUR_ACT number | DUR_PAS number | ID_GAR_VG text | NUM_ID text | NOCIONAL numeric(15,0) ? | MON_NOCIONAL varchar(3) ? | FECHAINFO date ymd ?",
    133: "FE_CON_OPE date ymd | NUM_ID varchar(20) | POS_OPER varchar(3) | OBJ_OPE varchar(2) | PAQ_EST numeric(2,0) | ID_PAQ_EST varchar(20) | CON_PAQ_EST numeric(3,0) | ACT_OPE numeric(15,0) | MON_ACT_OPE varchar(3) | PAS_OPE numeric(15,0) | MON_PAS_OPE varchar(3) | DUR_ACT numeric(5,0) | DUR_PAS numeric(5,0) | ID_GAR_VG varchar(20) | NOCIONAL numeric(15,0) ? | MON_NOCIONAL varchar(3) ? | FECHAINFO date ymd ?",
    140: "OFICINA varchar(1) | CONT varchar(6) | ID_GAR varchar(20) | CON_GTA numeric(3,0) | POS_GTA varchar(1) | TIP_GTA numeric(2,0) | CVE_TIT varchar(20) | EMI_ACT varchar(6) | FE_AV_BI date iso | RE_BM_BI varchar(20) | AFORO numeric(5,2) | VAL_GTA numeric(15,0) | MDA_GTA numeric(3,0) | FECHAINFO date dmy ?",
    142: "OFICINA varchar(1) | CONT varchar(6) | NETEO_POS numeric(2,0) | TIP_CONTRAT numeric(1,0) | EXP_POT numeric(15,0) | RSG_MAX numeric(15,0) | FECHAINFO date dmy ?",
    154: "OFICINA varchar(1) | CONT varchar(6) | FE_CON_OPE date ymd | FE1_FLU_RE date ymd | FEN_FLU_RE date ymd | FE1_FLU_EN date ymd | FEN_FLU_EN date ymd | TIP_DER numeric(2,0) | OBJ_OPE varchar(2) | REV_SWAP varchar(5) | DET_FLUJO varchar(2) | IMP_BASE numeric(15,0) | MDA_IMP varchar(3) | LIQ_FLU numeric(2,0) | NU_FLU_RE numeric(3,0) | NU_FLU_EN numeric(3,0) | INT_FLU_RE numeric(3,0) | INT_FLU_EN numeric(3,0) | TIP_TAS_RE varchar(3) | TAS_FIJ_RE numeric(9,6) | TAS_REF_RE varchar(20) | REV_TREF_RE numeric(3,0) | ANIO_RE varchar(1) | FE_REF_RE varchar(3) | FA1_TAS_RE numeric(8,6) | OP1_TAS_RE varchar(1) | PT1_TAS_RE numeric(9,6) | TIP_TAS_EN varchar(3) | TAS_FIJ_EN numeric(9,6) | TAS_REF_EN varchar(20) | REV_TREF_EN numeric(3,0) | ANIO_EN varchar(1) | FE_REF_EN varchar(3) | FA1_TAS_EN numeric(8,6) | OP1_TAS_EN varchar(1) | PT1_TAS_EN numeric(9,6) | CUO_COMP varchar(1) | VEN_ANT varchar(1) | TER_OPE varchar(1) | PAQ_EST numeric(2,0) | ID_PAQ_EST varchar(20) | CON_PAQ_EST numeric(3,0) | BROKER numeric(2,0) | SOCIO_LIQ varchar(6) | CAM_COM numeric(2,0) | AG_CAL varchar(6) | NUM_CONF varchar(34) | NU_ID varchar(34) | NUM_ID_OP_SBY varchar(34) | MODIFICA varchar(5) | INTERC_IMP varchar(1) | IMP_BA_RE numeric(15,0) | MDA_IMP_RE varchar(3) | IMP_BA_EN numeric(15,0) | MDA_IMP_EN varchar(3) | PRO_TER varchar(1) | FECVEN_A date ymd | FECLIQ_A date ymd | IMP_VEN numeric(15,0) | MDA_VEN varchar(3) | VTOT_IMPE numeric(15,0) | VPAR_IMPR numeric(15,0) | VPAR_IMPE numeric(15,0) | PAG_VENA varchar(1) | MOT_VENA numeric(1,0) | VEN_ANT_CD varchar(2) | NUM_ID_CP varchar(34) | UTI_N varchar(52) ? | UTI varchar(52) | UPI varchar(12) | FECHAINFO date ymd",
    155: "OFICINA text | CONT number | FE_CON_OPE date ymd | FE1_FLU_RE date ymd | FEN_FLU_RE date ymd | FE1_FLU_EN date ymd | FEN_FLU_EN date ymd | TIP_DER number | OBJ_OPE text | REV_SWAP text | DET_FLUJO text | INTERC_IMP text | IMP_BA_RE number | MDA_IMP_RE text | IMP_BA_EN number | MDA_IMP_EN text | LIQ_FLU number | NU_FLU_RE number | NU_FLU_EN number | INT_FLU_RE number | INT_FLU_EN number | TIP_LIQ text | MDA_LIQ text | SUBY_RE text | CVE_TIT_RE text | NU_SUBY_RE number | CUANT_RE text | PRE_SUB_RE numeric(13,6) | MDA_PRE_EN text | FE_EN_RE text | SUBY_EN text | CVE_TIT_EN text | NU_SUBY_EN number | CUANT_EN text | PRE_SUB_EN numeric(13,6) | MDA_PRE_RE text | FE_RE_EN text | CUO_COMP text | VEN_ANT text | TER_OPE text | PAQ_EST number | ID_PAQ_EST text | CON_PAQ_EST number | BROKER number | SOCIO_LIQ number | CAM_COM number | AG_CAL number | NUM_CONF text | NU_ID text | NUM_ID_OP_SBY text | MODIFICA text | UTI text | UPI text | FECHA_INFO date ymd ?",
    156: "CONT number | FECHA date ymd | NU_ID text | NU_FL_RE number | IMP_BA_RE number | FEIN_FL_RE date ymd | FEIN_VE_RE date ymd | SUBY_RE text | CVE_TIT_RE text | NU_SUBY_RE number | CUANT_RE text | PRE_SUB_RE numeric(13,6) | NU_FL_EN number | IMP_BA_EN number | FEIN_FL_EN date ymd | FEIN_VE_EN date ymd | SUBY_EN text | CVE_TIT_EN text | NU_SUBY_EN number | CUANT_EN text | PRE_SUB_EN numeric(13,6) | MODIFICA text | FECHAINFO date ymd ?",
    157: "CONT varchar(6) | FECHA date ymd | NU_ID varchar(34) | IMP_BASE numeric(15,0) | NU_FL_RE numeric(3,0) | FEIN_FL_RE date ymd ? | FEIN_VE_RE date ymd | TIP_TAS_RE varchar(3) | TAS_FIJ_RE numeric(9,6) | TAS_REF_RE varchar(20) | OP1_TAS_RE varchar(1) | PT1_TAS_RE numeric(9,6) | FE_REF_RE varchar(3) | NU_FL_EN numeric(3,0) | FE_IN_FLRE date ymd ? | FE_VE_FLEN date ymd | TIP_TAS_EN varchar(3) | TAS_FIJ_EN numeric(9,6) | TAS_REF_EN varchar(20) | OP1_TAS_EN varchar(1) | PT1_TAS_EN numeric(9,6) | FE_REF_EN varchar(3) | IMP_BA_EN numeric(15,0) | IMP_BA_RE numeric(15,0) | FEIN_FL_EN date ymd | FEIN_VE_EN date ymd | MODIFICA varchar(5) | FECHAINFO date ymd",
    209: "FECHA_LIQ date ymd | HORA_LIQ varchar(5) | TIPO_VALOR numeric(2,0) | MONTO_PAGOS numeric(12,0) | MONEDA varchar(3) | ID_PAGOS_REAL numeric(2,0) | CONT_CORRESPONSAL varchar(6) | CONT_RECEPTORA varchar(6) | CARACT_LIQUIDACION numeric(2,0) | FECHA_INFO date ymd",
    210: "FECHA_LIQ date ymd | HORA_LIQ varchar(5) | TIPO_VALOR numeric(2,0) | TIPO_OBLIGACION numeric(2,0) | MONTO_PAGOS numeric(12,0) | MONEDA varchar(3) | ID_PAGOS numeric(1,0) | FLAG_HORARIO numeric(1,0) | ID_PAGOS_RET numeric(1,0) | FECHA_EST_PAGO date ymd | HORA_EST_PAGO varchar(5) | PENALIZACION numeric(12,0) | MOTIVO_RET numeric(2,0) | ID_OPERACION varchar(50) | CARACT_LIQUIDACION numeric(2,0) | FECHA_INFO date ymd",
    212: "FECHA_EJE date ymd | HORA_USO varchar(5) | ID_LINEA varchar(50) | FECHA_LIQ_L date ymd | HORA_LIQ_L varchar(5) ? | MONTO_EJ_L numeric(12,0) | MONEDA_EJ_L varchar(3) | CAR_LINEA varchar(1) | PORC_CUBIERTO numeric(5,2) | TIPO_GAR varchar(2) | MONTO_PENALIZA numeric(12,0) | MOTIVO_REST varchar(2) | FECHA_INFO date ymd",
    213: "FECHA_OTORG_L date ymd | FECHA_MODIF_L date ymd | FECHA_VENC_L date ymd | ID_LINEA varchar(50) | ID_CONTRAPARTE varchar(6) | TIPO_LINEA varchar(1) | MONEDA_L varchar(3) | IND_CAMBIOS_L varchar(1) | MONTO_LINEA numeric(12,0) | FECHA_INFO date ymd",
}

# Stored but not delivered (the control column of four reports).
HIDDEN = {
    50: "FECHA_REPORTE date",
    93: "FECHA_INFO date ?",
    121: "FECHA_INFO date ?",
}

# --- Fixed values: report names, frequency, control column, load pattern. ---
# (numero, name, frequency, control column, source, landing table, inject column, sort)
REPORTS = [
    (21, "021_ENT_SWAPS_CONVO", WEEKLY, "FECHAINFO", "landing", "LMDA.SWAP_CONVO", None, ()),
    (50, "050_ENT_RC_CTACOB_INSUMO", MONTHLY, "FECHA_REPORTE", "landing", "LMDA.RC_CTACOB_INSUMO", None, ()),
    (75, "075_ENT_TENENCIA_REPAD", WEEKLY, LOAD_TS_COL, "landing", "LMDA.FT_TENENCIA", None, ()),
    (76, "076_ENT_REPORTOS_MN_ME", DAILY, "FECHA_INFO", "landing", "LMDA.REPORTOS_MN_ME", None, ()),
    (80, "080_CVT_TRP", DAILY, "FECHATRANS", "self", None, "FECHA_INFO", ()),
    (81, "081_CVT_TR", DAILY, "FECHATRANSFERENCIA", "self", None, "FECHA_INFO", ()),
    (83, "083_ENT_CVT_IN", DAILY, "FECHACONCERTACION", "self", None, "FECHA_INFO", ()),
    (84, "084_ENT_TENENCIA_PRECIO", WEEKLY, "FECHA_INFO", "landing", "LMDA.TENENCIA_PRECIO", None, ()),
    (93, "093_ENT_CF", WEEKLY, "FECHA_INFO", "landing", "LMDA.CF_I", None, ()),
    (121, "121_ENT_REPORTOS_MN_ME", DAILY, "FECHA_INFO", "landing", "LMDA.FT_REPORTOS", None, ()),
    (122, "122_ENT_REPORTOS_CANASTA", DAILY, "FECHA_INFO", "landing", "LMDA.CANASTA_REPORTOS", None, ()),
    (132, "132_ENT_FUT_CONVAL", DAILY, "FECHAINFO", "self", None, "FECHAINFO", ()),
    (133, "133_ENT_OFF_CONVAL", WEEKLY, "FECHAINFO", "landing", "LMDA.OFF_CONVAL", None, ()),
    (140, "140_ENT_GARANTIAS_II", WEEKLY, "FECHAINFO", "landing", "LMDA.GARANTIAS_II", None, ()),
    (142, "142_ENT_GARANTIAS_IV", MONTHLY, "FECHAINFO", "landing", "LMDA.GARANTIAS_IV", None, ()),
    (154, "154_ENT_SWAPS", DAILY, "FECHAINFO", "landing", "LMDA.SWAP", None, ()),
    (155, "155_ENT_SWAP_IV", DAILY, "FE_CON_OPE", "self", None, "FECHA_INFO", ()),
    (156, "156_ENT_SWAP_IV_COM", DAILY, "FECHA", "self", None, "FECHAINFO", ()),
    (157, "157_ENT_SWAP_FLUJOS", DAILY, "FECHAINFO", "landing", "LMDA.SWAP_FLUJO", None, ()),
    (209, "209_LID_CORRESPONSALES", MONTHLY, "FECHA_INFO", "landing", "LMDA.LID_CORRESPONSALES", None, ()),
    (210, "210_LID_LIQUIDACIONES", MONTHLY, "FECHA_INFO", "landing", "LMDA.LID_LIQUIDACIONES", None, ()),
    (212, "212_SECCION_5_LINEAS_CRE", MONTHLY, "FECHA_INFO", "self", None, None, ("FECHA_EJE", "ID_LINEA")),
    (213, "213_SECCION_A_CAT_LINEAS", MONTHLY, "FECHA_INFO", "self", None, None, ("ID_LINEA", "ID_CONTRAPARTE")),
]

# Landing column renamed on load into the report table (landing -> report).
LOAD_RENAMES = {50: (("CLAVE_BANXICO", "CLAVE_BAN"),)}

# --- Fixed values: file-name patterns and read options of the 15 file sources.
# (numero, pattern, file type, delimiter)
INGEST_SOURCES = [
    (21, r"^FILE_SWAP_CONVO.*\.xlsx?$", "excel", None),
    (50, r"^FILE_RC_CTACOB_INSUMO.*\.xlsx?$", "excel", None),
    (75, r"^FT_TENENCIA.*\.csv$", "csv", "|"),
    (76, r"^REPORTOS_MN_ME.*\.xlsx?$", "excel", None),
    (84, r"^TENENCIA_PRECIO.*\.xlsx?$", "excel", None),
    (93, r"^CF_I.*\.xlsx?$", "excel", None),
    (121, r"^FT_REPORTOS.*\.xlsx?$", "excel", None),
    (122, r"^CANASTA_REPORTOS.*\.xlsx?$", "excel", None),
    (133, r"^OFF_CONVAL.*\.xlsx?$", "excel", None),
    (140, r"^GARANTIAS_II.*\.xlsx?$", "excel", None),
    (142, r"^GARANTIAS_IV.*\.xlsx?$", "excel", None),
    (154, r"^FILE_SWAP\.xlsx?$", "excel", None),
    (157, r"^FILE_SWAP_FLUJO.*\.xlsx?$", "excel", None),
    (209, r"^LID_CORRESPONSALES.*\.xlsx?$", "excel", None),
    (210, r"^LID_LIQUIDACIONES.*\.xlsx?$", "excel", None),
]
# --- Fixed values: file header -> landing column where they differ (mixed-case
# --- headers of 121), control columns the file map does not carry (X3), and
# --- the one source that rejects empty cells.
HEADER_MAPS = {121: {"Custodio": "CUSTODIO", "FechaValor": "FECHAVALOR",
                     "Cliente": "CLIENTE", "Restriccion": "RESTRICCION"}}
UNMAPPED_CONTROL = {76: "FECHA_INFO", 93: "FECHA_INFO", 140: "FECHAINFO"}
NO_EMPTY = {50}

# --- Fixed values: earlier versions kept by the rollback scripts (frequency,
# --- control column, source, injected date).
PREVIOUS = {
    21: dict(frequency=MONTHLY, control="FE_CON_OPE", source="self"),
    50: dict(frequency=MONTHLY, control="FECHA_REPORTE", source="self",
             inject="period_start", inject_col="FECHA_REPORTE"),
    76: dict(frequency=DAILY, control="FECHAVENCIMIENTO", source="self"),
    84: dict(frequency=WEEKLY, control="FECHA_INFO", source="self",
             inject="period_start", inject_col="FECHA_INFO"),
    93: dict(frequency=WEEKLY, control="FECHA_INICIO", source="self"),
    121: dict(frequency=DAILY, control="FECHACONCERTACION"),
    122: dict(frequency=DAILY, control="FECHACONCERTACION"),
    140: dict(frequency=WEEKLY, control="FECHAINFO", source="self",
              inject="period_start", inject_col="FECHAINFO"),
    142: dict(frequency=WEEKLY, control="FECHAINFO", source="self",
              inject="period_start", inject_col="FECHAINFO"),
    132: dict(frequency=DAILY, control="FE_CORTE", source="self", inject="none", inject_col=None),
    133: dict(frequency=DAILY, control="FECHAINFO", delete_on="FE_CON_OPE"),
    154: dict(frequency=DAILY, control="FE_CON_OPE", source="self"),
    157: dict(frequency=DAILY, control="FECHA", source="self"),
    210: dict(frequency=DAILY, control="FECHA_LIQ"),
}


# --- Fixed values: columns of an earlier layout: how many of the current ones it begins
# --- with, and those that follow and that a later layout dropped.
PREVIOUS_LAYOUTS = {132: (18, "FE_CORTE date ? | ACT_OPE_VAL numeric(15,0) ? | PAS_OPE_VAL numeric(15,0) ?")}


# --- Fixed values: catalog bindings declared by the layouts (report column ->
# --- catalog name, and the zero-pad width for keys that mix text and numbers).
# --- The catalogs' allowed values are the regulator's catalog tables, loaded
# --- by the user (for example from their workbooks with the S3 scan).
CATALOG_BINDINGS = {
    121: (("POSICIONOPERACION", "PosicionOperacionRepo", None),
          ("MONEDAPRECIOUNITARIO", "MonedaISO", None),
          ("TIPOTASAPREMIO", "TipoTasaPremio_V1", None),
          ("CORROELECTRONICO", "CorroElectronico_V1", None),
          ("TIPOPOSTURA", "TipoPostura", None),
          ("OPERACIONBANCOTRABAJO", "OperacionRealizadaBanco", None),
          ("TIPOMODIFICACION", "TipoModificacion_V1", None),
          ("CLASIFICACIONCONTABLEOPERACION", "ClasificacionContableCVT", None),
          ("OFICINA", "CveOficina", None),
          ("SOBRETASA", "CveSobretasa", None),
          ("EMISOR", "CASFIM", 6),
          ("CONTRAPARTEREPORTO", "CASFIM", 6),
          ("CUSTODIO", "CASFIM", 6),
          ("CLIENTE", "CASFIM", 6),
          ("APLICA_ANEXO1C", "CveAplicaAnexo1C", None),
          ("FECHAVALOR", "Fecha Valor", None),
          ("RESTRICCION", "Restriccion", None)),
    133: (("POS_OPER", "PosicionOperacion_V4", None),
          ("OBJ_OPE", "OBJ_OPE_V1", None),
          ("PAQ_EST", "PAQ_EST_DER_V1", None),
          ("MON_ACT_OPE", "MonedaISO", None),
          ("MON_PAS_OPE", "MonedaISO", None),
          ("MON_NOCIONAL", "MonedaISO", None)),
    142: (("OFICINA", "ANEXO A", None),
          ("CONT", "ANEXO B", 6),
          ("NETEO_POS", "ANEXO M", None),
          ("TIP_CONTRAT", "ANEXO N", None)),
    210: (("TIPO_VALOR", "Tipo_valor", None),
          ("TIPO_OBLIGACION", "Tipo_Obligacion", None),
          ("MONEDA", "MonedaISO", None),
          ("ID_PAGOS", "Id_Pagos", None),
          ("FLAG_HORARIO", "Flag_Horario", None),
          ("ID_PAGOS_RET", "Id_Pagos_Ret", None),
          ("MOTIVO_RET", "MOTIVO_RET", None),
          ("CARACT_LIQUIDACION", "Caract_liq", None)),
}


# --- Fixed values: relations between reports described by the layouts.
# --- child report -> (parent report, key): every child key must exist in the parent
REFERENTIAL = {212: (213, "ID_LINEA")}
# --- report -> (companion report, key): rows read together by key
COMPANIONS = {155: (156, "NU_ID")}


def _build_reports() -> dict[int, ReportSpec]:
    out = {}
    for numero, name, freq, control, source, landing, inject_col, sort in REPORTS:
        cols = parse_layout(LAYOUTS[numero])
        hidden = parse_layout(HIDDEN[numero]) if numero in HIDDEN else ()
        out[numero] = ReportSpec(
            numero=numero, name=name, frequency=freq, control=control,
            columns=cols, hidden=hidden, source=source, landing=landing,
            load_renames=LOAD_RENAMES.get(numero, ()),
            inject="run_day" if inject_col else "none", inject_col=inject_col,
            sort=sort)
    return out


SPECS: dict[int, ReportSpec] = _build_reports()


def report(numero: int, version: str = "current") -> ReportSpec:
    """Spec of one report; ``version='prev'`` gives the rollback variant."""
    spec = SPECS[numero]
    if version == "current":
        return spec
    if version == "prev":
        changes = dict(PREVIOUS[numero])
        if numero in PREVIOUS_LAYOUTS:
            n, more = PREVIOUS_LAYOUTS[numero]
            changes["columns"] = spec.columns[:n] + parse_layout(more)
        return spec.with_version(version="prev", **changes)
    raise ValueError(version)


def report_142_versions() -> dict[str, ReportSpec]:
    """142 was delivered three ways: weekly yyyy/MM/dd, monthly yyyy/MM/dd, and
    monthly dd/MM/yyyy (current)."""
    cur = SPECS[142]
    ymd = tuple(LayoutColumn(c.name, c.type, c.nullable, c.out,
                             "yyyy/MM/dd" if c.fmt else None) for c in cur.columns)
    return {"weekly_ymd": cur.with_version(version="weekly", frequency=WEEKLY, columns=ymd),
            "monthly_ymd": cur.with_version(version="monthly", columns=ymd),
            "monthly_dmy": cur}


def _landing_name(numero: int, col: str) -> str:
    for landing, stored in LOAD_RENAMES.get(numero, ()):
        if stored == col:
            return landing
    return col


def _build_ingest() -> dict[int, IngestSpec]:
    out = {}
    for numero, pattern, ftype, delim in INGEST_SOURCES:
        spec = SPECS[numero]
        headers = HEADER_MAPS.get(numero, {})
        back = {v: k for k, v in headers.items()}
        skip = UNMAPPED_CONTROL.get(numero)
        layout_cols = [c for c in spec.stored_columns
                       if c.name != skip and c.name != LOAD_TS_COL]
        cmap, dates, nums, texts, final = [], [], [], [], [ID_COL]
        for c in layout_cols:
            land = _landing_name(numero, c.name)
            cmap.append((back.get(land, land), land))
            final.append(land)
            if c.type.kind == "date":
                dates.append(land)
            elif c.type.kind == "numeric":
                nums.append((land, c.type.sql_name))
            elif c.type.kind == "varchar":
                texts.append((land, c.type.length))
        final.append(LOAD_TS_COL)
        out[numero] = IngestSpec(
            name=spec.landing.split(".")[-1], file_pattern=pattern, landing=spec.landing,
            column_map=tuple(cmap), date_fields=tuple(dates), numeric_fields=tuple(nums),
            text_fields=tuple(texts), allow_empty=numero not in NO_EMPTY,
            final_columns=tuple(final), file_type=ftype, delimiter=delim or "|",
            control_col=None if spec.control == LOAD_TS_COL else _landing_name(numero, spec.control),
            control_from="run_date" if skip else "column",
            unmapped=(skip,) if skip else ())
    return out


INGEST: dict[int, IngestSpec] = _build_ingest()
