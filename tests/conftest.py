import random

import pytest

from palisade.session import local_session

TEST_DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="palisade-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def traffic(spark):
    """Labelled connections: every S0 and every land row is an attack, plus a few that no rule covers."""
    draw = random.Random(7)
    rows = []
    for i in range(2000):
        protocol = draw.choices(["tcp", "udp", "icmp"], [0.6, 0.3, 0.1])[0]
        service = draw.choice(["http", "ftp", "private", "smtp"])
        flag = draw.choices(["SF", "S0", "REJ"], [0.7, 0.2, 0.1])[0]
        land = int(draw.random() < 0.05)
        attack = int(flag == "S0" or land == 1 or draw.random() < 0.03)
        rows.append((i, protocol, service, flag, land, draw.gauss(2.0 * attack, 1.0), draw.gauss(0.0, 3.0), attack))
    return spark.createDataFrame(
        rows,
        "row_id bigint, protocol_type string, service string, flag string, land int, x double, z double, label int",
    ).cache()
