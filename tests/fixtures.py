"""Small inputs written for the tests, and golden rows of published sessions."""

SECONDS = "53.770902"

# Golden: two events exactly 1,800 s apart split a session.
# (id, minute of 2026-02-28, amount, category, location, session)
G1 = [
    ("7e101624", "03:16", 74.18, "grocery", "Boston", 1),
    ("ab024e47", "03:20", 272.53, "pharmacy", "Boston", 1),
    ("ad95be7b", "03:50", 49.00, "grocery", "Boston", 2),
    ("ea19641b", "04:10", 27.14, "pharmacy", "Boston", 2),
]
# session -> count, total, deviation
G1_SESSIONS = {1: (2, 346.71, 99.175), 2: (2, 76.14, 10.93)}

# Golden: three sessions, tied times, a session of one row.
G2 = [
    ("217df313", "01:08", 213.62, "grocery", "Boston", 1),
    ("bf100617", "01:14", 187.26, "pharmacy", "Boston", 1),
    ("94edc8af", "01:16", 154.19, "restaurant", "Boston", 1),
    ("e445cf46", "01:16", 162.00, "restaurant", "Boston", 1),
    ("ce0663e0", "01:18", 1558.54, "luxury", "New York", 1),
    ("bdf712de", "01:57", 1874.56, "electronics", "Las Vegas", 2),
    ("c6dd8e31", "01:59", 199.49, "grocery", "Boston", 2),
    ("2a975054", "03:02", 4921.18, "electronics", "Chicago", 3),
]
# session -> count, total, deviation, categories, locations, switches, high-value ratio
G2_SESSIONS = {
    1: (5, 2275.61, 552.1023682760, 4, 2, 1, 0.2),
    2: (2, 2074.05, 837.535, 2, 2, 1, 0.5),
    3: (1, 4921.18, 0.0, 1, 1, 0, 1.0),
}


def golden_rows(user, rows):
    return [
        (i, user, amount, category, location, f"2026-02-28T{minute}:{SECONDS}")
        for i, minute, amount, category, location, _ in rows
    ]


TXN = '{{"transaction_id":"{id}","user_id":"{user}","amount":{amount},"merchant_category":"{cat}","location":"{loc}","timestamp":"{ts}"}}'


def line(id="t", user="u", amount="12.5", cat="grocery", loc="Boston", ts="2026-01-01T00:00:00"):
    return TXN.format(id=id, user=user, amount=amount, cat=cat, loc=loc, ts=ts)
