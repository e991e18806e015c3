"""JDBC reads need a database, which is not available here; only the
predicate splitting is checked."""

from basketry.sources.jdbc import hash_predicates, master_predicates


def test_hash_predicates_cover_all_parts():
    ps = hash_predicates("client_id", 4)
    assert len(ps) == 4
    assert ps[0] == "MOD((hashtext(CAST(client_id AS text)) & 2147483647), 4) = 0"
    assert ps[-1].endswith("OR client_id IS NULL)")
    assert all("hashtext" in p for p in ps)


def test_master_tables_are_read_in_parallel():
    ps = master_predicates("jdbc:postgresql://db/shop", 3)
    assert [len(ps[n]) for n in ("clients", "sellers")] == [3, 3]
    assert "seller_id" in ps["sellers"][0] and "CRC32" in master_predicates("jdbc:mysql://db/shop", 2)["clients"][1]
    assert master_predicates("jdbc:postgresql://db/shop", 1) == {"clients": None, "sellers": None}
    assert master_predicates("jdbc:other:x", 8) == {"clients": None, "sellers": None}
