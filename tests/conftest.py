import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="govpub-test-")
    session = (SparkSession.builder.master("local[8]").appName("govpub-tests")
               .config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config("spark.log.level", "ERROR")
               .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g")
               .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
               .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch} -XX:TieredStopAtLevel=1 -XX:ReservedCodeCacheSize=400m -XX:+UseSerialGC")
               .config("spark.sql.catalogImplementation", "in-memory")
               .getOrCreate())
    yield session
    session.stop()


@pytest.fixture
def scratch():
    return Path(tempfile.mkdtemp(prefix="govpub-scratch-"))
