from conftest import rows
from pyspark.sql import functions as F

from shopgrain.functions import region
from shopgrain.plans.staging import stg_locations

PLACES = [
    ("ak", "US", "AK", "99501"),
    ("hi", "US", "HI", "96801"),
    ("pr", "US", "PR", "00901"),
    ("ny", "US", "NY", "10001"),
    ("qc", "CA", "QC", "H2X"),
    ("on", "CA", "ON", "K1A"),
    ("mx", "MX", "QC", "00901"),
    ("none", None, "AK", "00901"),
    ("nostate", "US", None, "10001"),
    ("nostate_pr", "US", None, "00901"),
    ("ca009", "CA", "ON", "00901"),
    ("nozip", "US", "NY", None),
]


def places(frame):
    return frame(
        "locations",
        *[dict(location_id=i, country_code=c, state=s, zip_code=z) for i, c, s, z in PLACES],
    )


def test_currency_and_rate(frame, rates):
    found = {r.location_id: (r.currency_code, r.exchange_rate_to_usd) for r in stg_locations(places(frame), rates).collect()}
    assert found["ny"] == ("USD", 1.0)
    assert found["on"] == ("CAD", 0.74)
    assert found["mx"] == ("UNKNOWN", 1.0)
    assert found["none"] == ("UNKNOWN", 1.0)


def test_a_missing_currency_row_gives_rate_one(frame, rates):
    only_usd = rates.where("currency_code = 'USD'")
    found = {r.location_id: r.exchange_rate_to_usd for r in stg_locations(places(frame), only_usd).collect()}
    assert found["qc"] == 1.0


def test_exclusion_and_reason(frame, rates):
    found = {
        r.location_id: (r.is_excluded_supply_chain, r.supply_chain_exclusion_reason)
        for r in stg_locations(places(frame), rates).collect()
    }
    assert {k for k, (flag, _) in found.items() if flag} == {"ak", "hi", "pr", "nostate_pr"}
    assert all((reason is not None) == flag for flag, reason in found.values())
    assert found["ak"][1].startswith("Alaska")
    assert found["hi"][1].startswith("Hawaii")
    assert found["pr"][1].startswith("Puerto Rico")
    assert found["nostate_pr"][1].startswith("Puerto Rico")


def test_quebec_columns(frame, rates):
    out = stg_locations(places(frame), rates)
    assert len(out.columns) == 14
    for r in out.collect():
        quebec = r.location_id == "qc"
        assert r.is_quebec_compliant_required is quebec
        assert r.marketing_language_requirement == ("EN,FR" if quebec else "EN")
        assert (r.quebec_compliance_notes is not None) is quebec
        if quebec:
            assert "Bill 101" in r.quebec_compliance_notes and "French" in r.quebec_compliance_notes


def test_region_type_and_flags(frame):
    c, s, z = F.col("country_code"), F.col("state"), F.col("zip_code")
    out = places(frame).select(
        "location_id",
        region.region_type(c, s, z).alias("kind"),
        region.requires_french_support(c, s).alias("french"),
        region.requires_compliance_flag(c, s).alias("flag"),
        region.is_fulfillable(c, s, z).alias("fulfillable"),
        region.excluded_state(s).alias("excluded_state"),
    )
    found = {r.location_id: r for r in out.collect()}
    assert {k: r.kind for k, r in found.items() if r.kind != "STANDARD"} == {
        "qc": "QC", "ak": "EXCLUDED", "hi": "EXCLUDED", "pr": "EXCLUDED", "nostate_pr": "EXCLUDED",
    }
    assert [k for k, r in found.items() if r.french] == ["qc"] == [k for k, r in found.items() if r.flag]
    # three-valued: unknown inputs leave the answer open
    assert found["none"].fulfillable is None
    assert found["nostate"].fulfillable is None
    assert found["nostate_pr"].fulfillable is False
    assert found["nozip"].fulfillable is None
    assert found["mx"].fulfillable is True
    assert found["ak"].fulfillable is False and found["ny"].fulfillable is True
    # the report flag looks at the state alone and is never NULL
    assert found["none"].excluded_state is True and found["nostate"].excluded_state is False


def test_zip_as_number_still_counts_as_text(spark):
    df = spark.createDataFrame([("US", "PR", 901)], "c string, s string, z int")
    out = df.select(region.is_excluded_supply_chain(F.col("c"), F.col("s"), F.col("z")))
    assert rows(out) == [(False,)]  # a numeric zip has lost its zeros: the reason for the fixed schema
