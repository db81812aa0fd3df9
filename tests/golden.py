"""A small hand-checked data set: an unknown product, an unknown user, an empty cart, a half cent."""

from __future__ import annotations

import json
from pathlib import Path

PRODUCTS = [
    {"id": 1, "title": "one", "category": "c1", "price": 10.50, "rating": {"rate": 3.9, "count": 120}},
    {"id": 2, "title": "two", "category": "c1", "price": 20.00, "rating": {"rate": 4.5, "count": 80}},
    {"id": 3, "title": "three", "category": "c2", "price": 5.25, "rating": {"rate": 2.0, "count": 50}},
    {"id": 4, "title": "four", "category": "c3", "price": 99.99, "rating": {"rate": 4.9, "count": 10}},
]

USERS = [
    {
        "id": n,
        "__v": 0,
        "email": email,
        "username": first.lower(),
        "password": "x",
        "phone": "1",
        "name": {"firstname": first, "lastname": last},
        "address": {
            "city": city,
            "street": "s",
            "number": n,
            "zipcode": "z",
            "geolocation": {"lat": "1.0", "long": "2.0"},
        },
    }
    for n, city, email, first, last in [
        (1, "Rome", "a@x", "Ann", "Ash"),
        (2, "Oslo", "b@x", "Bo", "Birk"),
        (3, "Rome", "c@x", "Cy", "Cole"),
    ]
]

CARTS = [
    {
        "id": n,
        "__v": 0,
        "userId": owner,
        "date": "2020-03-02T00:00:00.000Z",
        "products": [{"productId": p, "quantity": q} for p, q in lines],
    }
    for n, owner, lines in [
        (1, 3, [(1, 4), (2, 1)]),
        (2, 3, [(3, 2), (99, 5)]),
        (3, 1, [(1, 1), (4, 1)]),
        (4, 2, [(2, 3)]),
        (5, 2, []),
    ]
]

# Rows of each metric with the cart id as user key, in output order.
EXPECTED = {
    "revenue_by_category": [("c1", 132.5), ("c3", 99.99), ("c2", 10.5), (None, None)],
    "revenue_by_users_ID": [
        (3, "Cy", "Cole", "c@x", 110.49),
        (1, "Ann", "Ash", "a@x", 62.0),
        (4, None, None, None, 60.0),
        (2, "Bo", "Birk", "b@x", 10.5),
    ],
    "total_day_revenue": [(242.99,)],
    "total_quantity_per_prod": [(1, "c1", 5), (99, None, 5), (2, "c1", 4), (3, "c2", 2), (4, "c3", 1)],
    "avg_ordval_per_user": [
        (3, "Cy", "Cole", "c@x", 55.25),
        (4, None, None, None, 20.0),
        (1, "Ann", "Ash", "a@x", 15.25),
        (2, "Bo", "Birk", "b@x", 5.25),
    ],
    "avg_rat_per_cat": [("c3", 4.9), ("c1", 4.1), ("c2", 2.0), (None, None)],
    "total_revenue_per_city": [("Rome", 172.49), (None, 60.0), ("Oslo", 10.5)],
    "num_of_prod_sold": [(1, 2), (2, 2), (3, 1), (4, 1), (99, 1)],
    "rev_prod_cat": [("c3", 4, 99.99), ("c1", 2, 80.0), ("c1", 1, 52.5), ("c2", 3, 10.5), (None, 99, None)],
    "top_user_rev": [(3, "Cy", "Cole", "c@x", 110.49)],
    "top_prod_rev": [(4, "c3", 99.99)],
    "ord_bycity": [("Oslo", 7), ("Rome", 7), (None, 3)],
}


def write_raw(folder: Path) -> dict[str, str]:
    """One indented JSON array per kind, as the landing step receives them."""
    paths = {}
    for kind, rows in [("products", PRODUCTS), ("users", USERS), ("carts", CARTS)]:
        path = folder / f"{kind}.json"
        path.write_text(json.dumps(rows, indent=2))
        paths[kind] = str(path)
    return paths
