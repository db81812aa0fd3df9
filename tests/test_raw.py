"""Raw JSON with damage: nothing is lost without a word, and nothing good goes with it."""

import json

import pytest
from pyspark.errors import PySparkException

from tallyroll.sources import raw


def cart(i, quantity=1, **other):
    return {"id": i, "__v": 0, "userId": i, "date": "2020-03-02", "products": [{"productId": 1, "quantity": quantity}], **other}


# Text of a file; ids that are read from it; reasons of what is not.
FILES = {
    "good": (json.dumps([cart(1), cart(2)], indent=2), [1, 2], []),
    "single": ("\n " + json.dumps(cart(3)), [3], []),
    "marked": ("﻿" + json.dumps([cart(4)]), [4], []),
    "nulls": (json.dumps([cart(5, products=None), {"id": 6}, cart(7, extra={"id": "x"})]), [5, 6, 7], []),
    "none": ("[]", [], []),
    "cut": (json.dumps([cart(10), cart(11)])[:-20], [], [raw.UNREADABLE]),
    "half": (json.dumps([cart(12), cart(13, 2.5), cart(14)]), [12, 14], [raw.OTHER_TYPE]),
    "text_id": (json.dumps([dict(cart(0), id="15"), cart(16)]), [16], [raw.OTHER_TYPE]),
    "object": (json.dumps([cart(17, products={"productId": 1})]), [], [raw.OTHER_TYPE]),
    "large": (json.dumps([dict(cart(0), id=10**20)]), [], [raw.OTHER_TYPE]),
    "others": (json.dumps([cart(18), 5, "x", None, [1], "{}"]), [18], [raw.NO_DOCUMENT] * 5),
    "only_null": ("[null]", [], [raw.NO_DOCUMENT]),
    "number": ("17", [], [raw.UNREADABLE]),
    "two": (json.dumps([cart(19)]) + json.dumps([cart(20)]), [], [raw.UNREADABLE]),
    "lines": ("\n".join(json.dumps(cart(i)) for i in (21, 22)), [], [raw.UNREADABLE]),
    "behind": (json.dumps([cart(23)]) + " and more", [], [raw.UNREADABLE]),
    "closing": (json.dumps([cart(24)]) + ']],"x":[[1', [], [raw.UNREADABLE]),
    "list": (json.dumps([cart(25)]) + "," + json.dumps([cart(26)]), [], [raw.UNREADABLE]),
    "key": (json.dumps(cart(27)) + ',"x":' + json.dumps([cart(28)]), [], [raw.UNREADABLE]),
    "empty": ("", [], [raw.EMPTY_FILE]),
    "blank": (" \n ", [], [raw.UNREADABLE]),
}


def write(folder, names):
    folder.mkdir()
    for name in names:
        (folder / f"{name}.json").write_text(FILES[name][0], encoding="utf-8")
    return str(folder)


def test_everything_is_read_or_put_aside(spark, tmp_path):
    path, aside = write(tmp_path / "in", FILES), str(tmp_path / "aside")
    (tmp_path / "in" / "_SUCCESS").write_text("")
    read = raw.read_raw(spark, "carts", path, quarantine=aside).collect()
    assert sorted(r.id for r in read) == sorted(i for _, ids, _ in FILES.values() for i in ids)
    found = {}
    for r in raw.read_quarantine(spark, aside).collect():
        assert r.kind == "carts"
        found.setdefault(r.file.split("/")[-1][:-5], []).append(r)
    assert {name: sorted(r.reason for r in rows) for name, rows in found.items()} == {name: reasons for name, (_, _, reasons) in FILES.items() if reasons}
    # What was put aside can be mended and read again.
    (half,) = found["half"]
    assert half.place == 1 and json.loads(half.text) == cart(13, 2.5)
    assert found["cut"][0].text == FILES["cut"][0] and found["cut"][0].place is None


@pytest.mark.parametrize("name", [name for name, (_, _, reasons) in FILES.items() if reasons])
def test_damage_is_an_error_whatever_is_selected(spark, tmp_path, name):
    path = write(tmp_path / "in", ["good", name])
    with pytest.raises(PySparkException, match=f"DAMAGED_INPUT.*{name}.json"):
        raw.read_raw(spark, "carts", path).count()


def test_good_files_are_read_as_they_are(spark, tmp_path):
    names = [name for name, (_, _, reasons) in FILES.items() if not reasons]
    path = write(tmp_path / "in", names)
    rows = {r.id: r for r in raw.read_raw(spark, "carts", path).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6, 7]
    assert rows[1].products[0].asDict() == {"productId": 1, "quantity": 1} and rows[5].products is None and rows[6].date is None
    assert not (tmp_path / "aside").exists()
    raw.read_raw(spark, "carts", path, quarantine=str(tmp_path / "aside"))
    assert not (tmp_path / "aside").exists() and raw.read_quarantine(spark, str(tmp_path / "aside")).count() == 0


def test_json_lines(spark, tmp_path):
    lines = [json.dumps(cart(1)), "", json.dumps(cart(2)) + json.dumps(cart(3)), json.dumps(cart(4, 2.5)), "{", json.dumps(cart(5)), "7", " " + json.dumps(cart(6))]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.json").write_text("\n".join(lines))
    (tmp_path / "in" / "empty.json").write_text("")
    read = raw.read_raw(spark, "carts", str(tmp_path / "in"), multi_line=False, quarantine=str(tmp_path / "aside"))
    assert sorted(r.id for r in read.collect()) == [1, 5, 6]
    assert sorted(r.reason for r in raw.read_quarantine(spark, str(tmp_path / "aside")).collect()) == sorted([raw.UNREADABLE, raw.OTHER_TYPE, raw.UNREADABLE, raw.UNREADABLE])


def test_users_and_products(spark, tmp_path):
    product = {"id": 1, "title": "t", "price": 2, "rating": {"rate": 1.5, "count": 3}}
    (tmp_path / "p.json").write_text(json.dumps([product, {**product, "rating": {"rate": 1.5, "count": 3.5}}, {**product, "price": "9.99"}, {**product, "rating": None}]))
    (tmp_path / "u.json").write_text(json.dumps([{"id": 1, "address": {"geolocation": {"lat": 1.25}}}, {"id": 2, "address": "street"}]))
    read = raw.read_raw(spark, "products", str(tmp_path / "p.json"), quarantine=str(tmp_path / "aside")).collect()
    assert [(r.price, r.rating and r.rating["count"]) for r in read] == [(2.0, 3), (2.0, None)]
    users = raw.read_raw(spark, "users", str(tmp_path / "u.json"), quarantine=str(tmp_path / "aside")).collect()
    # Text fields take any value, as its text.
    assert [(r.id, r.address.geolocation.lat) for r in users] == [(1, "1.25")]
    assert [(r.kind, r.place) for r in raw.read_quarantine(spark, str(tmp_path / "aside")).orderBy("kind", "place").collect()] == [("products", 1), ("products", 2), ("users", 1)]
