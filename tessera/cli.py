"""Command line: python -m tessera.cli STEP --root FOLDER. `demo` runs all steps, each as a process of its own."""

from __future__ import annotations

import argparse
import os
import subprocess
import sys
import time
from collections.abc import Callable

from tessera import governance, runs
from tessera.operators import checks, contracts
from tessera.plans import build
from tessera.plans.model import GITHUB
from tessera.session import session
from tessera.sources import generator, ingest
from tessera.sources.store import TableStore


def _enforcer(run_id: str):
    def enforce(kind, df):
        valid, bad = contracts.enforce(df, contracts.GITHUB_CONTRACTS[kind])
        return valid, contracts.quarantine_rows(bad, run_id)

    return enforce


def _generate(a, store: Callable[[], TableStore]) -> int:
    print(generator.generate(a.landing, a.events, a.seed, a.corrupt))
    return 0


def _bronze(a, store) -> int:
    s, run = store(), runs.current_run_id()
    with runs.track_step(s, run, "bronze", "copy_into", "bronze") as m:
        n = ingest.copy_into(s, a.landing, run)
        m.rows_read, m.rows_written, m.rows_quarantined = n["lines"], n["events"], n["quarantined"]
    print(n)
    return 0


def _raw_vault(a, store) -> int:
    s, run = store(), runs.current_run_id()
    with runs.track_step(s, run, "raw_vault", "load", "silver") as m:
        n = build.load_raw_vault(s, GITHUB, _enforcer(run), full=a.full)
        m.rows_written = sum(v for k, v in n.items() if not k.startswith("quarantine"))
        m.rows_quarantined = n.get("quarantine")
        m.extra = {k: str(v) for k, v in n.items() if k.startswith("quarantine/")}
    print(n)
    return 0


def _verify(a, store) -> int:
    s, run = store(), runs.current_run_id()
    with runs.track_step(s, run, "raw_vault", "verify", "silver") as m:
        gained = build.verify_idempotent(s, GITHUB, _enforcer(run))
        m.rows_written = sum(gained.values())
    print(f"rows gained by a second load: {gained or 'none'}")
    return 2 if gained else 0


def _layer(name: str, layer: str, run_build):
    def step(a, store) -> int:
        s, run = store(), runs.current_run_id()
        with runs.track_step(s, run, name, "build", layer) as m:
            n = run_build(s)
            m.rows_written = sum(n.values())
        print(n)
        return 0

    return step


def _dq(a, store) -> int:
    s, run, failed = store(), runs.current_run_id(), 0
    for suite in checks.load_suites(a.suites or checks.SUITES):
        with runs.track_step(s, run, "dq", suite.table, suite.layer) as m:
            r = checks.run_suite(suite, s.read)
            m.rows_read, m.dq_checks_passed, m.dq_checks_failed, m.dq_pass_rate = r.row_count, r.count("pass"), r.count("fail"), r.pass_rate
        checks.write_report(r, f"{a.root}/runs/{run}/dq")
        failed += r.count("fail")
        for x in r.results:
            if not x.passed:
                print(f"{x.status}: {suite.table}: {x.check.describe()}: {x.observed}")
    return 1 if failed else 0


def _report(a, store) -> int:
    rows = runs.latest_run(store().read(runs.TABLE)).collect()
    print(runs.text_report(rows))
    with open(f"{a.root}/report.html", "w") as f:
        f.write(runs.html_report(rows))
    return 0


def _governance(a, store) -> int:
    for path in governance.write_generated(f"{a.root}/governance"):
        print(path)
    return 0


STEPS = {
    "generate": _generate, "bronze": _bronze, "raw-vault": _raw_vault, "verify": _verify, "business-vault": _layer("business_vault", "silver", build.build_business_vault),
    "gold": _layer("gold", "gold", build.build_gold), "dq": _dq, "report": _report, "governance": _governance,
}
DEMO = ("generate", "bronze", "raw-vault", "verify", "business-vault", "gold", "dq", "report")
TIMEOUTS = {"raw-vault": 1200, "verify": 1200}


def demo(argv: list[str]) -> int:
    """Each step in a process of its own under one run id; after a failure only the report is still made."""
    env = os.environ | {"LAKEHOUSE_RUN_ID": runs.current_run_id()}
    worst = 0
    for step in DEMO:
        if worst and step != "report":
            print(f"{step}: skipped")
            continue
        began = time.time()
        try:
            code = subprocess.run([sys.executable, "-m", "tessera.cli", step, *argv], env=env, timeout=TIMEOUTS.get(step, 900)).returncode
        except subprocess.TimeoutExpired:
            code = 124
        print(f"{step}: {'ok' if not code else f'failed ({code})'}, {time.time() - began:.0f} s")
        worst = worst or code
    return worst


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    if argv[:1] == ["demo"]:
        return demo(argv[1:])
    p = argparse.ArgumentParser(prog="tessera")
    p.add_argument("step", choices=[*STEPS, "demo"])
    p.add_argument("--root", required=True)
    p.add_argument("--landing")
    p.add_argument("--events", type=int, default=2000)
    p.add_argument("--seed", type=int, default=42)
    p.add_argument("--corrupt", type=float, default=0.02)
    p.add_argument("--master")
    p.add_argument("--suites", help="folder of check suites, instead of those of the feed")
    p.add_argument("--full", action="store_true", help="load the vault from all of bronze")
    a = p.parse_args(argv)
    a.landing = a.landing or f"{a.root}/landing"
    return STEPS[a.step](a, lambda: TableStore(session(f"tessera-{a.step}", a.master), a.root))


if __name__ == "__main__":
    sys.exit(main())
