"""Registry APIs: the sources' specifications, and requests answered from a cache first, then fetched with pauses and retries."""

from __future__ import annotations

import json
import random
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prodlake.operators.official import Source
from prodlake.sources.readers import cache_key

_MFDS = "https://apis.data.go.kr/1471000"
_ITEM = {"ids": ("ITEM_SEQ", "item_seq"), "names": ("ITEM_NAME", "item_name"), "makers": ("ENTP_NAME", "entp_name")}
_DRUG = {**_ITEM, "packs": ("PACK_UNIT", "pack_unit", "TOTAL_CONTENT"), "barcodes": ("BAR_CODE", "bar_code"), "images": ("BIG_PRDT_IMG_URL", "big_prdt_img_url")}
#: S-10 (fixed values): where each registry's records come from, and which of its fields mean what.
SOURCES = {
    s.key: s
    for s in (
        Source("drug_list", "15095677", "drug", f"{_MFDS}/DrugPrdtPrmsnInfoService07/getDrugPrdtPrmsnInq07", "item_seq", **_DRUG),
        Source("drug_detail", "15095677", "drug", f"{_MFDS}/DrugPrdtPrmsnInfoService07/getDrugPrdtPrmsnDtlInq06", "item_seq", **_DRUG, discovery=False),
        Source("drug_ingredients", "15095677", "drug", f"{_MFDS}/DrugPrdtPrmsnInfoService07/getDrugPrdtMcpnDtlInq07", "item_seq", **_ITEM, discovery=False),
        Source("easy_drug", "15075057", "drug", f"{_MFDS}/DrbEasyDrugInfoService/getDrbEasyDrugList", "itemSeq", ("itemSeq", "ITEM_SEQ"), ("itemName", "ITEM_NAME"), ("entpName", "ENTP_NAME"), images=("itemImage", "ITEM_IMAGE")),
        Source("pill_identification", "15057639", "drug", f"{_MFDS}/MdcinGrnIdntfcInfoService03/getMdcinGrnIdntfcInfoList03", "item_seq", **_ITEM, barcodes=("STD_CD", "std_cd"), images=("ITEM_IMAGE", "item_image")),
        Source("quasi_drug", "15095679", "quasi_drug", f"{_MFDS}/QdrgPrdtPrmsnInfoService03/getQdrgPrdtPrmsnInfoInq03", "item_seq", **_ITEM, packs=("PACK_UNIT", "pack_unit")),
        Source("supplement", "15056760", "supplement", f"{_MFDS}/HtfsInfoService03/getHtfsItem01", "sttemnt_no", ("STTEMNT_NO", "PRDLST_REPORT_NO", "sttemnt_no"), ("PRDUCT", "PRDLST_NM", "prduct"), ("ENTRPS", "BSSH_NM", "entrps"), ("DISPOS", "STDR_STND")),
        Source("functional_cosmetic_report", "15095680", "cosmetic", f"{_MFDS}/FtnltCosmRptPrdlstInfoService/getRptPrdlstInq", "item_seq", ("ITEM_SEQ", "COSMETIC_REPORT_SEQ"), ("ITEM_NAME",), ("ENTP_NAME", "MANUF_NAME")),
        Source("functional_cosmetic_review", "15056939", "cosmetic", "https://apis.data.go.kr/1471057/FtnltCosmSrngPrdlstInfoService04/getSrngPrdlstInq", "item_seq", ("ITEM_SEQ",), ("ITEM_NAME",), ("ENTP_NAME",), ("PACK_UNIT",)),
        Source("medical_device", "15073875", "medical_device", f"{_MFDS}/MdeqStdCdPrdtInfoService03/getMdeqStdCdPrdtInfoInq03", "UDI_DI", ("UDI_DI", "PRDLST_PRMISN_NO", "PRDLST_SEQ"), ("PRDT_NM", "PRDLST_NM", "MODEL_NM"), ("ENTP_NM", "ENTP_NAME")),
        Source("food_image", "15033307", "food", "https://apis.data.go.kr/B553748/CertImgListServiceV3/getCertImgListServiceV3", "prdlstReportNo", ("prdlstReportNo", "PRDLST_REPORT_NO"), ("prdlstNm", "PRDLST_NM"), ("manufacture", "company"), ("capacity",), ("barcode",), ("imgurl1", "imgUrl1", "productImg")),
    )
}



def requests(items: DataFrame, number: str, sources: dict[str, Source] = SOURCES) -> DataFrame:
    """S-09, S-10: a row for each item and source with what it is asked by number: source, dataset, domain, endpoint, params and their cache key."""
    specs = json.dumps([{"source": s.key, "dataset": s.dataset, "domain": s.domain, "endpoint": s.endpoint, "parameter": s.parameter, "discovery": s.discovery, "n_fields": len(s.ids) + len(s.names)} for s in sources.values()])
    each = items.withColumn("_s", F.explode(F.from_json(F.lit(specs), "array<struct<source:string,dataset:string,domain:string,endpoint:string,parameter:string,discovery:boolean,n_fields:int>>")))
    asked = each.select(*items.columns, "_s.*").withColumn("params", F.create_map("parameter", F.col(number).cast("string"), F.lit("type"), F.lit("json")))
    return asked.withColumn("cache_key", cache_key(F.col("endpoint"), F.col("params")))


Fetch = Callable[[str, dict[str, str]], str]


def http_get(endpoint: str, params: dict[str, str], timeout: float = 25.0) -> str:
    with urllib.request.urlopen(f"{endpoint}?{urllib.parse.urlencode(params)}", timeout=timeout) as answer:
        return answer.read().decode("utf-8-sig")


def _again(error: Exception) -> bool:
    return not isinstance(error, urllib.error.HTTPError) or error.code == 429 or error.code >= 500


def answered(requests: DataFrame, cache: DataFrame, fetch: Fetch = http_get, interval: float = 0.7, retries: int = 4, pause: float = 1.0, at_once: int = 1) -> DataFrame:
    """S-08: requests (endpoint, params as a map of texts) with key, payload, error and whether the answer was cached.

    cache: (key, payload), the answers of earlier runs, one row a key. Each different request that is not in it is made once, by
    at most `at_once` tasks, which keep `interval` seconds between requests; errors of the network, 429 and 5xx are tried again after
    growing pauses. What to add to the cache are the rows with a payload that were not cached.
    """
    keyed = requests.withColumn("key", cache_key(F.col("endpoint"), F.col("params")))
    found = keyed.join(cache.select("key", F.col("payload").alias("_known")), "key", "left")
    open_ones = found.where("_known is null").dropDuplicates(["key"]).select("key", "endpoint", F.to_json("params").alias("params"))

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = 0.0
        for frame in frames:
            rows = []
            for key, endpoint, params in frame.itertuples(index=False):
                payload, error = None, None
                for turn in range(retries + 1):
                    time.sleep(max(0.0, last + interval - time.monotonic()))
                    last = time.monotonic()
                    try:
                        payload, error = fetch(endpoint, json.loads(params)), None
                        json.loads(payload)
                        break
                    except (OSError, ValueError) as e:
                        payload, error = None, type(e).__name__
                        if not _again(e) or turn == retries:
                            break
                        time.sleep(pause * (2**turn + random.random()))
                rows.append((key, payload, error))
            yield pd.DataFrame(rows, columns=["key", "payload", "error"])

    fetched = open_ones.repartition(at_once, "key").mapInPandas(ask, "key string, payload string, error string")
    joined = found.join(fetched, "key", "left")
    return joined.select("endpoint", "params", "key", F.coalesce("_known", "payload").alias("payload"), "error", F.col("_known").isNotNull().alias("cached"))
