from __future__ import annotations

import pytest

from reviewmill import Stage, build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def stage(spark):
    return Stage(spark)


@pytest.fixture(scope="session")
def reviews(spark):
    """Build raw reviews from dicts; unnamed columns get defaults."""
    from datetime import datetime

    from reviewmill.schemas import RAW_REVIEWS

    defaults = dict(
        app_id="com.a", app_name="A", review_id="r", user_name="u", rating=3, review_text="text",
        thumbs_up=0, app_version="1.0", review_date=datetime(2026, 1, 10, 12), reply_text=None,
    )

    def make(*rows):
        full = [{**defaults, "review_id": f"r{i}", **row} for i, row in enumerate(rows)]
        return spark.createDataFrame([tuple(r[n] for n in RAW_REVIEWS.names) for r in full], RAW_REVIEWS)

    return make
