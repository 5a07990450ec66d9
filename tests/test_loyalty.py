import datetime as dt

import pytest

from tallyloom.operators import loyalty as L

SALES = "customer_id string, order_date date, product_id int"
MENU = "product_id int, product_name string, price int"
MEMBERS = "customer_id string, join_date date"


def day(n, month=1):
    return dt.date(2021, month, n)


@pytest.fixture
def menu(frame):
    return frame([(1, "scone", 4), (2, "soup", 9), (3, "pie", 7)], MENU)


@pytest.fixture
def house(frame):
    """One member who joins between visits, one guest account, and sales without a customer or a day."""
    sales = [("K", day(2), 3), ("K", day(2), 1), ("K", day(4), 2), ("K", day(9), 1), ("K", day(9), 1), ("K", day(20), 3), ("M", day(3), 2), (None, day(3), 2), ("K", None, 1), (None, None, 3)]
    return frame(sales, SALES), frame([("K", day(4))], MEMBERS)


def test_flag_and_rank(house, menu, rows):
    sales, members = house
    ranked = L.member_rank(sales, menu, members)
    assert ranked.count() == sales.count()
    assert rows(ranked.filter("customer_id = 'K'"), "order_date", "product_name", "price", "member", "ranking") == sorted(
        [
            (day(2), "pie", 7, "N", None),
            (day(2), "scone", 4, "N", None),
            (day(4), "soup", 9, "Y", 1),
            (day(9), "scone", 4, "Y", 2),
            (day(9), "scone", 4, "Y", 2),
            (day(20), "pie", 7, "Y", 3),
            (None, "scone", 4, "N", None),
        ],
        key=repr,
    )
    flagged = L.membership_flag(sales, menu, members)
    assert rows(flagged.filter("customer_id is null or customer_id = 'M'"), "member") == [("N",)] * 3
    assert rows(ranked.drop("ranking")) == rows(flagged)


def test_rank_keeps_equal_sales_and_ties(frame, menu, rows):
    sales = frame([("A", day(2), 1), ("A", day(2), 1), ("A", day(2), 2), ("A", day(9), 2)], SALES)
    ranked = L.member_rank(sales, menu, frame([("A", day(1))], MEMBERS))
    assert rows(ranked, "product_name", "ranking") == [("scone", 1), ("scone", 1), ("soup", 1), ("soup", 2)]


def test_first_items_keep_ties_once(frame, menu, rows):
    sales = frame([("A", day(1), 1), ("A", day(1), 1), ("A", day(1), 2), ("A", day(2), 3), ("B", day(5), 3)], SALES)
    assert rows(L.first_event_items(sales, menu), "customer_id", "product_name") == [("A", "scone"), ("A", "soup"), ("B", "pie")]


def test_favourite_keeps_ties(frame, menu, rows):
    sales = frame([("A", day(1), 1), ("A", day(2), 2), ("B", day(1), 3), ("B", day(2), 3), ("B", day(2), 1)], SALES)
    assert rows(L.favorite_item(sales, menu), "customer_id", "product_name") == [("A", "scone"), ("A", "soup"), ("B", "pie")]


def test_favourite_adds_up_ids_with_one_name(frame, rows):
    menu = frame([(1, "tea", 1), (2, "tea", 2), (3, "cake", 3)], MENU)
    sales = frame([("A", day(1), 1), ("A", day(1), 2), ("A", day(1), 3)], SALES)
    assert rows(L.favorite_item(sales, menu), "product_name", "times_ordered") == [("tea", 2)]


def test_nearest_event_sides(frame, rows):
    sales = frame([("A", day(4), 1), ("A", day(5), 2), ("A", day(6), 3), ("A", day(4), 1)], SALES)
    members = frame([("A", day(5))], MEMBERS)
    assert rows(L.nearest_event(sales, members, "after"), "product_id") == [(2,)]
    assert rows(L.nearest_event(sales, members, "after", inclusive=False), "product_id") == [(3,)]
    assert rows(L.nearest_event(sales, members, "before"), "product_id") == [(1,), (1,)]
    assert rows(L.nearest_event(sales, members, "before", inclusive=True), "product_id") == [(2,)]
    with pytest.raises(ValueError):
        L.nearest_event(sales, members, "around")


def test_first_items_of_known_customers_and_days(house, menu, rows):
    sales, _ = house
    assert rows(L.first_event_items(sales, menu), "customer_id", "product_name") == [("K", "pie"), ("K", "scone"), ("M", "soup")]


def test_totals_before_joining(house, menu, rows):
    sales, members = house
    assert rows(L.pre_anchor_totals(sales, menu, members)) == [("K", 2, 11)]


def test_points(house, menu, rows):
    sales, members = house
    # K: pies 14, soup 9, scones 4 times; scones earn double
    assert dict(rows(L.loyalty_points(sales, menu, L.PointRules(special_id=1)))) == {"K": 140 + 90 + 320, "M": 90, None: 90 + 70}
    bonus = L.PointRules(special_name="scone", bonus_days=7, last_day="2021-01-10")
    # 70 + 80 before joining, 180 + 80 + 80 in the bonus week; the 20th is past the last day
    assert rows(L.loyalty_points(sales, menu, bonus, members)) == [("K", 490)]


def test_bonus_week_ends_after_seven_days(frame, menu, rows):
    sales = frame([("A", day(11), 2), ("A", day(12), 2)], SALES)
    rules = L.PointRules(bonus_days=7)
    assert rows(L.loyalty_points(sales, menu, rules, frame([("A", day(5))], MEMBERS))) == [("A", 270)]


def test_spend_visits_and_counts(house, menu, rows):
    sales, _ = house
    assert dict(rows(L.spend_by_entity(sales, menu))) == {"K": 14 + 9 + 16, "M": 9, None: 16}
    assert dict(rows(L.visit_days(sales))) == {"K": 4, "M": 1, None: 1}
    assert [tuple(r) for r in L.item_counts(sales, menu).collect()] == [("scone", 4), ("pie", 3), ("soup", 3)]
    assert [tuple(r) for r in L.item_counts(sales, menu, top=1).collect()] == [("scone", 4)]
