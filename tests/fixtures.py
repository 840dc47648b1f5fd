"""Small documents in both feed shapes. All values are invented."""

from __future__ import annotations

import json
from pathlib import Path

from feedmart.sources import schemas

AIRPORTS = [
    ("GMP", "Gimpo", "KR", "Asia/Seoul"),
    ("CJU", "Jeju", "KR", "Asia/Seoul"),
    ("ICN", "Incheon", "KR", "Asia/Seoul"),
    ("NRT", "Narita", "JP", "Asia/Tokyo"),
    ("JFK", "Kennedy", "US", "America/New_York"),
    ("CDG", "Roissy", "FR", "Europe/Paris"),
]


def airports(spark):
    return spark.createDataFrame(AIRPORTS, schemas.struct(schemas.AIRPORT_INFO))


def write(root, day, feed, name, doc, text=None):
    folder = Path(root) / day / feed
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text if text is not None else json.dumps(doc, ensure_ascii=False))
    return str(folder)


def fare(agent="A1", adult=50000, tax=4000, fuel=7700, fee=1000, **more):
    return {
        "agtCode": agent, "adultFare": adult, "aTax": tax, "aFuel": fuel, "publishFee": fee, **more
    }


def schedule(dep="GMP", arr="CJU", at="202505300600", until="202505300710", seat="Y", fares=None,
             journey="01:10", airline="Sky Air", code="SA", number="SA101"):
    return {
        "airlineCode": code, "airlineName": airline, "fitName": number, "depCity": dep,
        "arrCity": arr, "departureDate": at, "arrivalDate": until, "seatClass": seat,
        "journeyTime": journey, "fare": [fare()] if fares is None else fares,
    }


def domestic_doc(*departures, arrivals=()):
    return {
        "data": {
            "domesticFlights": {"departures": list(departures), "arrivals": list(arrivals)},
            "promotions": [],
        }
    }


def leg(sa, ea, sdt, edt, av="SA", ct="0000", jt="0200"):
    return {"sa": sa, "ea": ea, "sdt": sdt, "edt": edt, "av": av, "ct": ct, "jt": jt}


def itinerary(*legs, journey=("02", "00")):
    return {"id": "x", "detail": list(legs), "journeyTime": list(journey)}


def price(fare="100000", naver="0", tax="20000", q="500", agent="A1", url="FareRuleItnInfo=a/b/K&x=1"):
    return {
        "Adult": {"Fare": fare, "NaverFare": naver, "Tax": tax, "QCharge": q},
        "AgtCode": agent,
        **({"priceTransparencyUrl": {"#cdata-section": f"http://f.example/r?{url}"}} if url else {}),
    }


ANY_PAYMENT = "%EC%84%B1%EC%9D%B8%2F%EB%AA%A8%EB%93%A0+%EA%B2%B0%EC%A0%9C%EC%88%98%EB%8B%A8"


def international_doc(schedules, fares, airlines=None, fare_types=None):
    return {
        "data": {
            "internationalList": {
                "results": {
                    "airlines": airlines or {"SA": "Sky%20Air", "OA": "Ocean+Air"},
                    "fareTypes": fare_types or {"A01": ANY_PAYMENT, "A02": "Card"},
                    "schedules": schedules,
                    "fares": fares,
                }
            }
        }
    }


def fares_of(*prices, option="A01"):
    return {"sch": [], "fare": {option: list(prices)}}


def shuffles(df):
    """What the plan's shuffles go by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.partition("hashpartitioning(")[2] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
