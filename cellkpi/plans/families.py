"""KPI specifications of the counter families (vendor x technology).

Each family is a rule over its input schema — "aggregate every counter
column" — plus the few exceptions the source system states: other
functions (max/avg), renames, second aliases, label columns and keys.
Counter names therefore come from the data's registered schema, not from
copied lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from cellkpi.operators.spec import CounterRule, Item, KpiSpec, Measure
from cellkpi.sources.schema import IDENTITY

# ----------------------------------------------------------------------------
# Fixed values that must equal the source system's specifications.
# ----------------------------------------------------------------------------

# Ericsson LTE: maxima taken with IFNULL(x,0).
ERIC_LTE_MAX = ("pmRrcConnMax", "pmPdcpBitrateDlDrbMax", "pmPdcpBitrateUlDrbMax")
# Ericsson LTE: counters emitted a second time under a '_gcr' name.
ERIC_LTE_GCR = ("pmHoPrepAtt", "pmHoPrepSucc", "pmHoExeAtt", "pmHoExeSucc")
# Ericsson LTE: second name of the reporting-period duration.
ERIC_LTE_DURATION_ALIAS = "period_duration_eutcfd19"
# Ericsson LTE: the interference histogram's bins are renamed (both specs).
ERIC_LTE_BIN_RENAMES = tuple((f"pmRadioRecInterferencePwrPucch_{i}", f"pmRadioRecInterfernPwrPucch_{i}") for i in range(16))
# Ericsson LTE ROP spec: renamed handover counters. (The hourly spec reads and
# writes the names on the right.)
ERIC_LTE_HO_RENAMES = (
    ("pmCellHoExeAttLteInterF", "pmHoExeAttLteInterF"), ("pmCellHoExeAttLteIntraF", "pmHoExeAttLteIntraF"),
    ("pmCellHoExeSuccLteInterF", "pmHoExeSuccLteInterF"), ("pmCellHoExeSuccLteIntraF", "pmHoExeSuccLteIntraF"),
    ("pmCellHoPrepAttLteInterF", "pmHoPrepAttLteInterF"), ("pmCellHoPrepAttLteIntraF", "pmHoPrepAttLteIntraF"),
    ("pmCellHoPrepSuccLteInterF", "pmHoPrepSuccLteInterF"), ("pmCellHoPrepSuccLteIntraF", "pmHoPrepSuccLteIntraF"))
# Ericsson UMTS ROP spec: one renamed counter.
ERIC_UMTS_RENAMES = (("pmNoRabEstablishAttemptSpeech", "pmNoRabEstablishAttempSpeech"),)
# Ericsson UMTS: sector layer and sort key expressions.
UMTS_SORT_KEY = "concat(substr(UtranCell, 1, 1), substr(UtranCell, -1, 1), substr(UtranCell, -2, 1))"
UMTS_SECTOR_LAYER = "case when substring(UtranCell, 1, 1) = 'U' then 'AWS' else 'PCS' end"
UMTS_SITE = "concat('U', substring(UtranCell, 2, 8))"

# Nokia LTE families (store type = 'lte_' + name) and their non-sum measures.
NOKIA_LTE_FAMILIES = (
    "cell_avail", "eps_bearer", "handover", "inter_enb_ho", "inter_sys_ho", "intra_enb_ho",
    "isys_ho_gsm_nb_sum", "isys_ho_utran_nb_sum", "cell_load", "pwr_and_qual_dl",
    "pwr_and_qual_ul", "cell_resource", "rrc", "cell_throughput", "ue_state", "ue_quantity",
)
NOKIA_LTE_OVERRIDES = {
    "cell_load": (("pdcp_sdu_delay_dl_dtch_mean", "avg"), ("pdcp_sdu_delay_ul_dtch_mean", "avg"),
                  ("rrc_conn_ue_max", "max"), ("cell_load_act_ue_avg", "avg"),
                  ("cell_load_act_ue_max", "max"), ("rrc_conn_ue_avg", "avg")),
    "pwr_and_qual_dl": (("cqi_off_mean", "avg"),),
    "pwr_and_qual_ul": (("rssi_pucch_avg", "avg"), ("rssi_pusch_avg", "avg"),
                        ("ue_pwr_headroom_pusch_avg", "avg"), ("sinr_pucch_avg", "avg"),
                        ("sinr_pusch_avg", "avg")),
    "cell_throughput": (("pdcp_data_rate_max_ul", "max"), ("pdcp_data_rate_max_dl", "max")),
    "ue_quantity": (("cell_load_active_ue_avg", "avg"), ("cell_load_active_ue_max", "max"),
                    ("rrc_connected_ue_avg", "avg"), ("rrc_connected_ue_max", "max")),
}
NOKIA_LTE_RENAMES = {"inter_enb_ho": (("fail_enb_ho_prep_ac", "fail_enb_ho_prep_ac_lien"),)}
NOKIA_SOURCE_KEYED = ("isys_ho_gsm_nb_sum", "isys_ho_utran_nb_sum")   # key mo_dn_source, not mo_dn

# Nokia UMTS families: schemas exist, specifications do not (derived rule).
NOKIA_UMTS_FAMILIES = (
    "cell_resource", "cell_throughput_wbts", "hsdpa_wbts", "inter_system_handover",
    "intra_system_handover", "packet_call", "rcpm_olpc_wcel_sum", "rcpm_rlc_wcel_sum", "rrc",
    "service_level", "soft_handover", "traffic",
)

ENRICHED = ("HL_Market", "HL_Cluster", "HL_Area", "HL_Site", "HL_Sector", "HL_Market_Suffix",
            "HL_Date", "HL_Date_Hour", "HL_DATE", "HL_MARKET")

# ----------------------------------------------------------------------------


def ericsson_lte(counters: Sequence[str], hourly: bool = False) -> KpiSpec:
    """Ericsson LTE: SUM(IFNULL(c,0)), three floored maxima, labels by MIN, ROP
    keys (or hour keys without OSS for the hourly spec). ``counters``: the
    counters that the spec names (the schema has ten times as many), for
    example ``[m.source for m in typed_measures(text)]`` of its feature file."""
    rule = CounterRule(
        func="sum", null_policy="zero",
        overrides=tuple((c, "max") for c in ERIC_LTE_MAX),
        also=tuple((c, f"{c}_gcr") for c in ERIC_LTE_GCR) + (("period_duration", ERIC_LTE_DURATION_ALIAS),),
        renames=ERIC_LTE_BIN_RENAMES + (() if hourly else ERIC_LTE_HO_RENAMES),
        only=(*counters, "period_duration"),
    )
    items = [
        Item("MGR_RUN_ID", "run_id", "unassigned"),
        Measure("min", "region", "Region"), Measure("min", "market", "Market"),
        Measure("min", "subnetwork_2", "SubNetwork_2"),
        Item("PERIOD_START_TIME", "time", "hl_date" if hourly else "PERIOD_START_TIME"),
        Item("MeContext", "key", "MeContext"), Item("EUtranCellFDD", "key", "EUtranCellFDD"),
        rule,
        Item("HL_Date_Hour", "time", "hl_date"),
        Item("HL_Date", "time", "hl_date" if hourly else "PERIOD_START_TIME"),
        Item("HL_Sector", "key", "eutrancellfdd"), Item("HL_Sectorlayer", "const", ""),
        Item("HL_Site", "key", "mecontext"), Item("HL_Cluster", "key", "HL_Cluster"),
        Item("HL_Area", "key", "HL_Area"), Item("HL_Market", "key", "HL_Market"),
    ]
    keys = ["mecontext", "eutrancellfdd", "hl_market", "hl_cluster", "hl_area"]
    if not hourly:
        items.append(Item("OSS", "key", "OSSName"))
        keys.append("OSSName")
    return KpiSpec(name="lte_eric" + ("_hourly" if hourly else ""), items=tuple(items), keys=tuple(keys),
                   time_keys=("hl_date",) if hourly else ("hl_date", "period_start_time"),
                   hour_key="hl_date", identity=IDENTITY[("ericsson", "lte")] + ENRICHED)


def ericsson_umts(counters: Sequence[str], hourly: bool = False) -> KpiSpec:
    """Ericsson UMTS; ``counters`` as for :func:`ericsson_lte`."""
    rule = CounterRule(func="sum", null_policy="zero", renames=() if hourly else ERIC_UMTS_RENAMES,
                       only=tuple(counters))
    items = [
        Item("MGR_RUN_ID", "run_id", "unassigned"),
        Measure("min", "region", "region"), Measure("min", "market", "market"),
        Measure("min", "subnetwork_2", "subnetwork_2"),
        Item("PERIOD_START_TIME", "time", "hl_date" if hourly else "PERIOD_START_TIME"),
        Measure("sum", "PERIOD_DURATION", "PERIOD_DURATION"),
        Measure("min", "mecontext", "mecontext"), Item("utrancell", "key", "utrancell"),
        rule,
        Item("hl_umtssort", "key", UMTS_SORT_KEY),
        Item("HL_Date_Hour", "time", "hl_date"),
        Item("HL_Date", "time", "hl_date" if hourly else "PERIOD_START_TIME"),
        Item("HL_Sector", "key", "utrancell"), Item("HL_Sectorlayer", "key", UMTS_SECTOR_LAYER),
    ]
    if hourly:
        items += [Item("HL_Site", "key", UMTS_SITE), Item("HL_Cluster", "const", "unassigned"),
                  Item("HL_Area", "const", "unassigned"), Item("HL_Market", "key", "HL_Market")]
        keys = ("hl_market", "utrancell")
    else:
        items += [Item("HL_Site", "key", "HL_Site"), Item("HL_Cluster", "key", "HL_Cluster"),
                  Item("HL_Area", "key", "HL_Area"), Item("HL_Market", "key", "HL_Market"),
                  Item("OSS", "key", "OSSName")]
        keys = ("utrancell", "hl_market", "hl_cluster", "hl_area", "hl_site", "OSSName")
    return KpiSpec(name="umts_eric" + ("_hourly" if hourly else ""), items=tuple(items), keys=keys,
                   time_keys=("hl_date",) if hourly else ("hl_date", "period_start_time"),
                   hour_key="hl_date", identity=IDENTITY[("ericsson", "umts")] + ENRICHED)


def nokia_lte(family: str) -> KpiSpec:
    """Nokia LTE family: SUM of every counter (NULL when all NULL), stated
    max/avg exceptions, MIN(oss) label; ROP keys. Use grain='hour' for the
    hl_date-grain variant."""
    if family not in NOKIA_LTE_FAMILIES:
        raise KeyError(family)
    mo_key = "mo_dn_source" if family in NOKIA_SOURCE_KEYED else "mo_dn"
    rule = CounterRule(func="sum", null_policy="keep", overrides=NOKIA_LTE_OVERRIDES.get(family, ()),
                       renames=NOKIA_LTE_RENAMES.get(family, ()))
    items = (
        Item("MGR_RUN_ID", "run_id", "unassigned"),
        Measure("min", "oss", "oss"),
        Item("PERIOD_START_TIME", "time", "PERIOD_START_TIME"),
        Measure("sum", "period_duration", "period_duration"),
        Item("mo_dn", "key", mo_key), Item("cell", "key", "mo_dn2"),
        rule,
        Item("HL_Date_Hour", "time", "HL_Date_Hour"), Item("HL_Date", "time", "HL_Date"),
        Item("HL_Sector", "key", "HL_Sector"), Item("HL_Sectorlayer", "const", ""),
        Item("HL_Site", "key", "HL_Site"), Item("HL_Cluster", "key", "HL_Cluster"),
        Item("HL_Area", "key", "HL_Area"), Item("HL_Market", "key", "HL_Market"),
    )
    return KpiSpec(name=f"lte_nokia_{family}", items=items,
                   keys=(mo_key, "mo_dn2", "hl_sector", "hl_site", "hl_cluster", "hl_area", "hl_market"),
                   time_keys=("hl_date", "HL_Date_Hour", "PERIOD_START_TIME"), hour_key="hl_date",
                   identity=IDENTITY[("nokia", "lte")] + ENRICHED)


def nokia_umts(family: str) -> KpiSpec:
    """Derived (not stated by the source system): SUM of every counter and
    the duration, MIN(oss); keys period, BASEID, LOCALMOID, CELL_ID_1/2, HL_*."""
    if family not in NOKIA_UMTS_FAMILIES:
        raise KeyError(family)
    items = (
        Item("MGR_RUN_ID", "run_id", "unassigned"),
        Measure("min", "oss", "oss"),
        Item("PERIOD_START_TIME", "time", "PERIOD_START_TIME"),
        Measure("sum", "period_duration", "period_duration"),
        Item("BASEID", "key", "BASEID"), Item("LOCALMOID", "key", "LOCALMOID"),
        Item("CELL_ID_1", "key", "CELL_ID_1"), Item("CELL_ID_2", "key", "CELL_ID_2"),
        CounterRule(func="sum", null_policy="keep"),
        Item("HL_Date_Hour", "time", "HL_Date_Hour"), Item("HL_Date", "time", "HL_Date"),
        Item("HL_Sector", "key", "HL_Sector"), Item("HL_Sectorlayer", "const", ""),
        Item("HL_Site", "key", "HL_Site"), Item("HL_Cluster", "key", "HL_Cluster"),
        Item("HL_Area", "key", "HL_Area"), Item("HL_Market", "key", "HL_Market"),
    )
    return KpiSpec(name=f"umts_nokia_{family}", items=items,
                   keys=("BASEID", "LOCALMOID", "CELL_ID_1", "CELL_ID_2", "hl_sector", "hl_site",
                         "hl_cluster", "hl_area", "hl_market"),
                   time_keys=("hl_date", "HL_Date_Hour", "PERIOD_START_TIME"), hour_key="hl_date",
                   identity=IDENTITY[("nokia", "umts")] + ENRICHED, derived=True)
