"""Small inputs in the source system's shapes (schemas, delimited files, lookup)."""

from __future__ import annotations

import json
import os

from pyspark.sql import types as T

from cellkpi.sources.schema import schema_from_fields


def field(name, typ="double", **extra):
    d = {"metadata": {}, "type": typ, "name": name, "nullable": True}
    d.update(extra)
    return d


NOKIA_LTE_ID = [field("MGR_RUN_ID", "string"), field("Region", "string"), field("Market", "string"),
                field("OSS", "string"), field("PERIOD_START_TIME", "timestamp"), field("PERIOD_DURATION"),
                field("MO_DN", "string"), field("MO_DN2", "string")]

CELL_AVAIL = NOKIA_LTE_ID + [field("SAMPLES_CELL_AVAIL"), field("SAMPLES_CELL_PLAN_UNAVAIL"),
                             field("SAMPLES_CELL_UNPLAN_UNAVAIL"), field("DENOM_CELL_AVAIL")]
CELL_LOAD = NOKIA_LTE_ID + [field("rach_stp_att_small_msg"), field("rrc_conn_ue_max", "string"),
                            field("rrc_conn_ue_avg", "string"), field("cell_load_act_ue_max", "string"),
                            field("cell_load_act_ue_avg", "string")]
CELL_THROUGHPUT = NOKIA_LTE_ID + [field("pdcp_sdu_vol_ul", "long"), field("pdcp_data_rate_max_ul"),
                                  field("pdcp_data_rate_max_dl"), field("IP_TPUT_TIME_UL_QCI_6")]
GSM_NB = [f if f["name"] != "MO_DN" else field("MO_DN_Source", "string") for f in NOKIA_LTE_ID] + [
    field("ISYS_HO_GERAN_SRVCC_ATT_NB"), field("ISYS_HO_GERAN_SRVCC_FAIL_NB")]

UMTS_ID = [field("MGR_RUN_ID", "string"), field("Region", "string"), field("Market", "string"),
           field("OSS", "string"), field("PERIOD_START_TIME", "timestamp"), field("PERIOD_DURATION"),
           field("BASEID", "string"), field("LOCALMOID", "string"), field("CELL_ID_1", "string"),
           field("CELL_ID_2", "string")]
SOFT_HO = UMTS_ID + [field("cpich_ecno_class_0"), field("cpich_ecno_class_1"), field("cell_add_req_on_sho_for_rt", "string")]

ERIC_LTE = [field("HL_DATE", "timestamp"), field("HL_MARKET", "string"), field("Region", "string"),
            field("Market", "string"), field("SubNetwork_2", "string"), field("MeContext", "string"),
            field("EUtranCellFDD", "string"), field("PERIOD_START_TIME", "timestamp"),
            field("PERIOD_DURATION", agg="SUM"), field("OSSName", "string"),
            field("pmRrcConnEstabAtt"), field("pmRrcConnMax"), field("pmHoPrepAtt"),
            field("pmCellHoExeAttLteInterF"), field("pmRadioRecInterferencePwrPucch_0"),
            field("pmPdcchCceUtil_0"), field("pmPdcchCceUtil_1"), field("pmPdcchCceUtil_2")]

ERIC_UMTS = [field("HL_DATE", "timestamp"), field("HL_MARKET", "string"), field("Region", "string"),
             field("Market", "string"), field("SubNetwork_2", "string"), field("MeContext", "string"),
             field("UtranCell", "string"), field("PERIOD_START_TIME", "timestamp"),
             field("PERIOD_DURATION"), field("OSSName", "string"),
             field("pmNoRabEstablishAttemptSpeech"), field("pmnorabestablishsuccessspeech")]


def schema(fields) -> T.StructType:
    return schema_from_fields(fields)


def write_schema_dir(path, families: dict[str, list]) -> str:
    os.makedirs(path, exist_ok=True)
    for name, fields in families.items():
        with open(os.path.join(path, f"{name}_schema.json"), "w") as fh:
            json.dump(fields, fh)
    return path


def write_delimited(path, header: list[str], rows: list[list], sep: str) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(sep.join(header) + "\n")
        for r in rows:
            fh.write(sep.join("" if v is None else str(v) for v in r) + "\n")
    return path


LOOKUP_ROWS = [
    # TECH, VENDOR, MARKET, MARKET_SUFFIX, OSS, CELL, CELL_UID, CLUSTER, AREA, SITE
    ("LTE", "Nokia", "NEW YORK", "nyc", "OSS1", "C1", "UID1", "CL1", "AR1", "S1"),
    ("LTE", "Nokia", "NEW YORK", "nyc", "OSS1", "C2", "UID2", "CL1", "AR1", "S1"),
    ("LTE", "Nokia", "LONG_ISLAND/EAST", "lie", "OSS2", "C3", "UID3", "CL2", "AR2", "S2"),
    ("LTE", "Nokia", "NEW YORK", "nyc", "OSS1", "C2", "UID2", "CL9", "AR9", "S9"),   # duplicate key
    ("LTE", "Ericsson", "NEW YORK", "nyc", "OSS1", "C1", "UID1", "CL1", "AR1", "S1"),
    ("UMTS", "Ericsson", "NEW YORK", "nyc", "OSS1", "U1234567890", "U1", "CL1", "AR1", "SITE-U"),
    ("UMTS", "Nokia", "NO SUFFIX", None, "OSS3", "X1", "UID9", "CL3", "AR3", "S3"),
]
LOOKUP_SCHEMA = ("TECH string, VENDOR string, MARKET string, MARKET_SUFFIX string, OSS string, CELL string, "
                 "CELL_UID string, CLUSTER string, AREA string, SITE string")


def lookup_df(spark):
    return spark.createDataFrame(LOOKUP_ROWS, LOOKUP_SCHEMA)
