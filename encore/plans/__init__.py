"""The daily jobs, each a ``DataFrame(s) -> DataFrame`` function.

client_log  J1  raw log lines -> play table, per-event records
songs       J2  song dimension; J3 song daily features
influence   J4  song influence; J5 singer influence; J14 top-n export
machines    J6  machine dimension
location    J7  machine location snapshot
money       J11 consumption detail; J8 machine statistics; J12 merchant shares; J13 region totals
users       J9  active users; J10 newly active users
"""
