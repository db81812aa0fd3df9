"""Fixed schemas of the raw documents.

The JSON reader matches field names case-sensitively, so the names are spelled as in the
data; the flattening step gives them their output names.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


_LONG, _DOUBLE, _TEXT = T.LongType(), T.DoubleType(), T.StringType()

USERS = _struct(
    id=_LONG,
    __v=_LONG,
    email=_TEXT,
    username=_TEXT,
    password=_TEXT,
    phone=_TEXT,
    name=_struct(firstname=_TEXT, lastname=_TEXT),
    address=_struct(
        city=_TEXT,
        street=_TEXT,
        number=_LONG,
        zipcode=_TEXT,
        geolocation=_struct(lat=_TEXT, long=_TEXT),
    ),
)

PRODUCTS = _struct(
    id=_LONG,
    title=_TEXT,
    price=_DOUBLE,
    description=_TEXT,
    category=_TEXT,
    image=_TEXT,
    rating=_struct(rate=_DOUBLE, count=_LONG),
)

CARTS = _struct(
    id=_LONG,
    __v=_LONG,
    userId=_LONG,
    date=_TEXT,
    products=T.ArrayType(_struct(productId=_LONG, quantity=_LONG)),
)

RAW = {"users": USERS, "products": PRODUCTS, "carts": CARTS}
