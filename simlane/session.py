"""Session factory and the settings the engine relies on."""

from __future__ import annotations

import configparser
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: UTC so that timestamps mean the same everywhere; AQE for run-time coalescing, skew splits and join changes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(app: str = "simlane", master: str | None = None, **conf: object) -> SparkSession:
    """A session with SETTINGS; keyword arguments use '_' for '.', as in spark_driver_memory='4g'."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in (SETTINGS | {k.replace("_", "."): str(v) for k, v in conf.items()}).items():
        b = b.config(k, v)
    return b.getOrCreate()


def read_settings(path: str, section: str = "spark") -> dict[str, str]:
    """The settings of a section of a configuration file ('name = value' lines below [section]), for
    session(**{name with '_' for '.': value})."""
    parser = configparser.ConfigParser(interpolation=None)
    parser.optionxform = str
    with open(path, encoding="utf-8") as f:
        parser.read_file(f)
    return {k.replace(".", "_"): v for k, v in parser[section].items()}


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names, which driver and executors share; the context's checkpoint folder is
    set to it if there is none. Where it is unset, a temporary folder serves a local master and others get an error."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="simlane-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(named)
    return named.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """df written to the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
