import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from postgauge.session import build_session

    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_posts(spark):
    """Sixty labelled posts of twenty users; one user wrote a third of them."""
    rows = []
    for i in range(60):
        y = int(i % 3 == 0)
        user = "heavy" if i < 20 else f"u{i % 19}"
        word = "dark night alone" if y else "sunny garden friends"
        rows.append((user, f"t{i:02d}", f"Title {i}", f"{word} word{i % 7} Común ñandú", "yes" if y else "no"))
    return spark.createDataFrame(
        rows, "user_id string, text_id string, title string, text string, is_suicide string"
    )
