"""Machine location (J7): the most-reported position of each machine over a trailing
window, enriched with address fields, merged over the previous day's snapshot.

Enrichment is pluggable (a function ``top -> enriched``):

* ``lookup_enricher(lookup)`` - left join to a location table keyed by (x, y);
* ``geocode_requests`` + ``flatten_geocode`` - batched request strings out, service
  responses back in as data, joined by (batch, position);
* ``map_in_batches`` (operators) - a caller function over row slices inside the tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.functions.dates import check_day, day_minus
from encore.operators.sets import snapshot_merge
from encore.operators.windows import global_row_number, top1_by

# Success code of a geocode response, and the request batch sizes used by
# the daily job (10) and the long-window variant (100).
GEOCODE_OK = "10000"
BATCH_SIZE = 10
LONG_BATCH_SIZE = 100

ADDRESS_FIELDS = ["addr", "prvc", "cty", "cty_cd", "district", "ad_cd", "town_ship", "town_cd", "nb_nm", "nb_tp",
                  "bd_nm", "bd_tp", "street", "street_nb", "street_loc", "street_drction", "street_dstance",
                  "bus_info"]
LOCATION_COLUMNS = ["mid", "x", "y", "cnt"] + ADDRESS_FIELDS

# Where each address field sits in a geocode response element.
RESPONSE_PATHS = {
    "addr": "formatted_address", "prvc": "addressComponent.province", "cty": "addressComponent.city",
    "cty_cd": "addressComponent.citycode", "district": "addressComponent.district",
    "ad_cd": "addressComponent.adcode", "town_ship": "addressComponent.township",
    "town_cd": "addressComponent.towncode", "nb_nm": "addressComponent.neighborhood.name",
    "nb_tp": "addressComponent.neighborhood.type", "bd_nm": "addressComponent.building.name",
    "bd_tp": "addressComponent.building.type", "street": "addressComponent.streetNumber.street",
    "street_nb": "addressComponent.streetNumber.number", "street_loc": "addressComponent.streetNumber.location",
    "street_drction": "addressComponent.streetNumber.direction",
    "street_dstance": "addressComponent.streetNumber.distance",
    "bus_info": "addressComponent.businessAreas",
}
RESPONSE_SCHEMA = (
    "infocode string, regeocodes array<struct<formatted_address: string, addressComponent: struct<"
    "province: string, city: string, citycode: string, district: string, adcode: string, township: string, "
    "towncode: string, neighborhood: struct<name: string, type: string>, building: struct<name: string, "
    "type: string>, streetNumber: struct<street: string, number: string, location: string, direction: string, "
    "distance: string>, businessAreas: string>>>")


def location_state(reports: DataFrame, start: str, end: str, by_day: bool = False) -> DataFrame:
    """Distinct (user, machine, lat, lng) reports of ``[start, end]`` with the last day seen
    (``yyyyMMdd`` as int) - the state the votes are counted from.  ``by_day`` keeps one
    partial per day, with ``data_dt``."""
    return (reports.where(F.col("data_dt").between(check_day(start), check_day(end)))
                   .groupBy("uid", "mid", "lat", "lng", *(["data_dt"] if by_day else []))
                   .agg(F.max(F.col("data_dt").try_cast("int")).alias("last")))


def combine_location_partials(partials: DataFrame) -> DataFrame:
    """The location state of the days whose partials are given."""
    return partials.groupBy("uid", "mid", "lat", "lng").agg(F.max("last").alias("last"))


def advance_location_state(state: DataFrame, reports: DataFrame, day: str, days: int = 30) -> DataFrame:
    """Yesterday's state -> today's: drop reports older than ``day-days``, fold in the
    reports of ``day`` only (reads one day instead of ``days + 1``)."""
    lo = int(day_minus(day, days))
    kept = state.select("uid", "mid", "lat", "lng", "last").where(F.col("last") >= lo)
    return (kept.unionByName(location_state(reports, day, day))
                .groupBy("uid", "mid", "lat", "lng").agg(F.max("last").alias("last")))


def votes_from_state(state: DataFrame) -> DataFrame:
    """One vote per user and position: ``mid, x (lat), y (lng), cnt``."""
    return (state.groupBy("mid", "lat", "lng").count()
                 .select("mid", F.col("lat").alias("x"), F.col("lng").alias("y"), F.col("count").alias("cnt")))


def location_votes(reports: DataFrame, day: str, days: int = 30) -> DataFrame:
    """Distinct reporters per (machine, lat, lng) over ``[day-days, day]``: one vote per
    user and position.  Columns ``mid, x (lat), y (lng), cnt``."""
    check_day(day)
    return votes_from_state(location_state(reports, day_minus(day, days), day))


def top_location(votes: DataFrame) -> DataFrame:
    """Most-voted position per machine (ties: smallest x, then y), and only then blank
    positions are dropped - a machine whose top position is blank gets no row."""
    best = top1_by(votes, ["mid"], "cnt", ["x", "y"])
    return best.where((F.col("x") != "") & (F.col("y") != "")).select("mid", "x", "y", "cnt")


def lookup_enricher(lookup: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Enrichment by a location table with unique (x, y) and the 18 address fields.  A
    position that the table lacks gives no row, so yesterday's row of the machine stays."""
    def enrich(top: DataFrame) -> DataFrame:
        j = top.join(lookup.select("x", "y", *ADDRESS_FIELDS), ["x", "y"])
        # NULL or missing fields become '' (as a blank-if-null rule).
        return j.selectExpr("mid", "x", "y", "cnt", *[f"coalesce(`{c}`, '') AS `{c}`" for c in ADDRESS_FIELDS])
    return enrich


def geocode_requests(top: DataFrame, batch_size: int = BATCH_SIZE) -> DataFrame:
    """Number the machines (by id) and cut them into request batches.

    Columns ``mid, x, y, cnt, batch_id, pos``; numbering is distributed (no task sees all
    machines) and deterministic."""
    numbered = global_row_number(top.withColumn("_all", F.lit(0)), ["_all"],
                                 [F.col("mid").asc_nulls_first(), F.col("x").asc(), F.col("y").asc()], name="_rn")
    i = F.col("_rn") - 1
    return numbered.select("mid", "x", "y", "cnt", F.floor(i / batch_size).cast("bigint").alias("batch_id"),
                           (i % batch_size).cast("int").alias("pos"))


def geocode_batches(requests: DataFrame) -> DataFrame:
    """One request per batch: ``lng,lat`` pairs in position order joined by ``|``.
    A batch holds at most ``batch_size`` rows, so the collected list is bounded."""
    pairs = F.array_sort(F.collect_list(F.struct("pos", F.concat_ws(",", "y", "x").alias("loc"))))
    return (requests.groupBy("batch_id")
                    .agg(F.count(F.lit(1)).alias("n"), pairs.alias("_p"))
                    .select("batch_id", "n", F.array_join(F.transform("_p", lambda s: s["loc"]), "|")
                            .alias("location")))


def flatten_geocode(responses: DataFrame, requests: DataFrame) -> DataFrame:
    """Join service responses (``batch_id, body``) back to the requested machines.

    A batch counts only if its ``infocode`` is the success code and it returned one
    element per requested machine; otherwise its machines get no row.  Missing or NULL
    leaves become ``''``."""
    parsed = responses.select("batch_id", F.from_json("body", RESPONSE_SCHEMA).alias("r"))
    sizes = requests.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))
    good = (parsed.join(sizes, "batch_id")
                  .where((F.col("r.infocode") == GEOCODE_OK) & (F.size("r.regeocodes") == F.col("n"))))
    elems = good.select("batch_id", F.posexplode("r.regeocodes").alias("pos", "g"))
    j = requests.join(elems, ["batch_id", "pos"], "inner")
    return j.selectExpr("mid", "x", "y", "cnt",
                        *[f"coalesce(g.{path}, '') AS `{c}`" for c, path in RESPONSE_PATHS.items()])


def service_enricher(call: Callable[[str], str], responses_path: str,
                     batch_size: int = BATCH_SIZE) -> Callable[[DataFrame], DataFrame]:
    """Enrichment through an outside geocoding service.

    ``call(location)`` receives one batch's ``lng,lat|lng,lat|...`` string and returns the
    service's JSON body; it runs inside the tasks (``mapInPandas``), one call per batch.
    Responses are written to ``responses_path`` (shared storage) before they are used, so
    later stages never repeat a call; a retried or speculative task of the write itself may,
    so a batch is requested at least once.  Responses join back by (batch, position)."""
    import pandas as pd

    def enrich(top: DataFrame) -> DataFrame:
        requests = geocode_requests(top, batch_size)

        def run(it):
            for pdf in it:
                yield pd.DataFrame({"batch_id": pdf["batch_id"], "body": [call(loc) for loc in pdf["location"]]})

        (geocode_batches(requests).mapInPandas(run, "batch_id long, body string")
         .write.mode("overwrite").parquet(responses_path))
        responses = top.sparkSession.read.schema("batch_id long, body string").parquet(responses_path)
        return flatten_geocode(responses, requests)
    return enrich


def machine_location(reports: DataFrame, prev: DataFrame | None, day: str,
                     enrich: Callable[[DataFrame], DataFrame], days: int = 30,
                     votes: DataFrame | None = None) -> DataFrame:
    """Today's snapshot: freshly located machines win; machines not located in the window
    keep yesterday's row (``prev``, may be None).  NULL machine ids are dropped.
    ``votes`` (e.g. from a kept ``location_state``) replaces the scan of ``reports``."""
    if votes is None:
        votes = location_votes(reports, day, days)
    new = enrich(top_location(votes)).select(*LOCATION_COLUMNS)
    if prev is None:
        return new.where(F.col("mid").isNotNull())
    return snapshot_merge(new, prev.select(*LOCATION_COLUMNS), "mid")
