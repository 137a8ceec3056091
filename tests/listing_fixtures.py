"""Small silver tables and raw feeds with every edge the rules name."""

import json
import os
import random

from forecourt import fixed_values as fixed
from forecourt.operators.shape import SILVER


def silver_row(**values):
    return tuple(values.get(c) for c in fixed.SILVER_COLUMNS)


def silver_table(spark, n=400, seed=3):
    rng = random.Random(seed)
    prices = [0.01, 9999.99, 10000.0, 20000.0, 35000.0, 60000.0, 100000.0]
    rows = []
    for i in range(n):
        price = prices[i] if i < len(prices) else round(rng.uniform(500, 120000), 2)
        make = rng.choice([" ford ", "Kia", "KIA", "audi", None])
        dealer = rng.choice([1, 1, 1, 2, 3])
        rows.append(silver_row(
            vin=f"V{i}", listing_id=None if i % 17 == 0 else f"L{i}", make=make,
            model=rng.choice(["A", "B"]), year=rng.choice([2027, 2028, 2026, 2025, 2020, 2001, 2000, 1979, None]),
            bodytype=rng.choice(["suv", "sedan", None]), current_price=rng.choice([price] * 9 + [None, -1.0]),
            list_price=rng.choice([price + 500, 0.0, None]), mileage=rng.choice([0, 20000, 50000, 99999, 150000, None, -5]),
            mpg_city=rng.choice([20.0, None]), mpg_combined=rng.choice([25.5, None]),
            dealer_carfax_id=f"D{dealer}", dealer_name=f"Dealer {dealer}", dealer_city="X", dealer_state="Y",
            dealer_type="new", dealer_avg_rating=rng.choice([4.5, None]) if dealer == 3 else 4.0,
            dealer_review_count=10, image_count=rng.randrange(5), follow_count=i,
            accident_history=rng.choice(['{"icon":"accident"}', '{"icon":"none"}', None, "bad"]),
            owner_history='{"history":[1]}', service_history=rng.choice(['{"number":3}', None]),
            top_options=rng.choice(['["a","b"]', None]), tp_retention_score=rng.choice([1.5, None]),
            monthly_payment=rng.choice([300.0, None]), monthly_term_months=rng.choice([60, 0, None]),
            first_seen=rng.choice(["2026-01-01T00:00:00Z", None])))
    return spark.createDataFrame(rows, SILVER)


def raw_record(vin, **over):
    record = {"vin": vin, "id": f"id-{vin}", "year": 2020, "make": " ford ", "model": "F-150\t", "mileage": 10,
              "listPrice": 100.5, "currentPrice": "99", "vehicleCondition": "Used",
              "dealer": {"name": "Joe", "zip": "30301-1234", "latitude": "33.5", "longitude": "abc", "city": " atlanta "},
              "monthlyPaymentEstimate": {"price": 1.5, "termInMonths": 60}, "topOptions": ["a", "b"], "images": None,
              "accidentHistory": {"icon": "accident"}, "firstSeen": "2024-01-05", "sortTPScore": 9, "surprise": [1]}
    record.update(over)
    return record


def write_feed(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        for r in records:
            f.write((r if isinstance(r, str) else json.dumps(r)) + "\n")
