import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SHOW = """
import json
from postwave.session import build_session, cluster_conf
s = build_session()
c = s.sparkContext.getConf()
print("SHOWN", json.dumps({"master": s.sparkContext.master, "parts": s.conf.get("spark.sql.shuffle.partitions"),
                           "memory": c.get("spark.driver.memory", None), "zone": s.conf.get("spark.sql.session.timeZone"),
                           "big": cluster_conf(100 << 40)["spark.sql.shuffle.partitions"]}))
s.stop()
"""


def shown(**env):
    clean = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_SUBMIT", "PYSPARK_GATEWAY", "POSTWAVE"))}
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=ROOT, env=clean | env, capture_output=True, text=True, timeout=300)
    return json.loads(next(x for x in out.stdout.splitlines() if x.startswith("SHOWN"))[6:])


def test_outside_settings_stay():
    got = shown(PYSPARK_SUBMIT_ARGS="--master local[2] --conf spark.sql.shuffle.partitions=77 --driver-memory 700m pyspark-shell")
    assert (got["master"], got["parts"], got["memory"]) == ("local[2]", "77", "700m") and got["zone"] == "UTC"
    assert int(got["big"]) == (100 << 40) // (128 << 20)


def test_defaults_without_outside_settings():
    got = shown()
    assert (got["master"], got["parts"]) == ("local[8]", "8") and got["memory"].endswith("g")
