import csv
import glob
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

from test_pipelines import CALLS, ROSTER  # noqa: E402


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def _read_dir(path):
    out = []
    for f in sorted(glob.glob(f"{path}/part-*.csv")):
        with open(f, encoding="utf-8") as fh:
            out += list(csv.DictReader(fh))
    return out


def test_cli_presence_build_then_analytics(tmp_dir):
    _write(f"{tmp_dir}/calls/calls.csv", CALLS)
    _write(f"{tmp_dir}/roster/r.csv", "".join(l + ",\n" for l in ROSTER.strip("\n").split("\n")))
    _write(f"{tmp_dir}/names.csv", "from_value,to_value\nAidaluna,AIDAluna\n")
    _write(f"{tmp_dir}/excl.csv", "date,boat\n03.05.2023,Queen Victoria\n")
    env = dict(os.environ, PYTHONPATH=REPO, BENCH_CPUS="2")
    run = [sys.executable, "-m", "quayside"]
    subprocess.run(run + ["presence-build", "--calls", f"{tmp_dir}/calls", "--roster",
                          f"{tmp_dir}/roster", "--boat-names", f"{tmp_dir}/names.csv",
                          "--call-exclusions", f"{tmp_dir}/excl.csv", "--out", f"{tmp_dir}/out"],
                   check=True, env=env, capture_output=True, timeout=600)
    hourly = _read_dir(f"{tmp_dir}/out/hourly")
    assert {r["boat"] for r in hourly} == {"AIDAluna", "Bolette", "Jewel of the Seas"}
    assert len(hourly) == 9 + 8 + 7
    # the hourly output is the harbour and the cleaned sales are the sales, as they are
    _write(f"{tmp_dir}/fix.csv", "boat,passengers\nBolette,100.0\n")
    _write(f"{tmp_dir}/s/s.csv", "Måned,Dag,Time,Varegruppe,Antall,Belåp m/mva\n"
                                 "5,1,10,1,10.0,\"99,00\"\n5,1,10,1,few,1\n")
    subprocess.run(run + ["clean-sales", "--raw", f"{tmp_dir}/s", "--out", f"{tmp_dir}/sold"],
                   check=True, env=env, capture_output=True, timeout=600)
    assert [r["Units sold"] for r in _read_dir(f"{tmp_dir}/sold/rejects")] == ["few"]
    _write(f"{tmp_dir}/n/n.csv", "boat,nationality\nAIDAluna,Tysk\nBolette,UK\nJewel of the Seas,US\n")
    _write(f"{tmp_dir}/nn.csv", "from_value,to_value\nTysk,DE\n")
    _write(f"{tmp_dir}/d/d.csv", "product,EN\n1,Souvenir\n")
    subprocess.run(run + ["analytics", "--harbour", f"{tmp_dir}/out/hourly", "--sales",
                          f"{tmp_dir}/sold/sales", "--nationalities", f"{tmp_dir}/n",
                          "--dictionary", f"{tmp_dir}/d", "--passenger-fixes", f"{tmp_dir}/fix.csv",
                          "--nationality-names", f"{tmp_dir}/nn.csv", "--out", f"{tmp_dir}/res"],
                   check=True, env=env, capture_output=True, timeout=600)
    rep = {r["nationality"]: r for r in _read_dir(f"{tmp_dir}/res/replicated_product_share")}
    assert set(rep) == {"DE", "UK"} and rep["DE"]["total_units_sold"] == "10"
    app = {r["nationality"]: r for r in _read_dir(f"{tmp_dir}/res/apportioned_product_share")}
    # 10:00: AIDAluna 2000 and Bolette 100 by the fix
    assert app["DE"]["total_units_sold"] == "10" and app["UK"]["total_units_sold"] == "0"
