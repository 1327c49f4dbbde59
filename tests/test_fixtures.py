"""Known figures of the test domain, and the choice of the shared folder."""

import pytest
from conftest import SF

from wardstream.operators import clean, kpis
from wardstream.operators.latest import latest_encounter
from wardstream.plans import registry
from wardstream.session import scratch_dir

# Figures observed for the derived domain at two scales.
KNOWN = {
    "0.001": {
        "usable": 1000,
        "quarantined": 0,
        "dirty_age": 134,
        "future": 3,
        "latest": 15,
        "tied": 0,
        "occupancy": {"Female": 85.714, "Male": 100.0},
        "turnover": {"Female": 1.0, "Male": 1.0},
        "admitted": {"Female": 6, "Male": 8},
        "groups": (9, 3, 9, 7),
        "versions": 20,
    },
    "0.01": {
        "usable": 10000,
        "quarantined": 0,
        "dirty_age": 1283,
        "future": 62,
        "latest": 150,
        "tied": 10,
        "occupancy": {"Female": 90.667, "Male": 86.667},
        "turnover": {"Female": 1.0, "Male": 1.0},
        "admitted": {"Female": 68, "Male": 65},
        "groups": (10, 5, 10, 10),
        "versions": 235,
    },
}


@pytest.mark.parametrize("sf", sorted(KNOWN))
def test_known_figures(spark, sf):
    sf_dir, known = SF.replace("0.001", sf), KNOWN[sf]
    usable = registry.usable(spark, sf_dir)
    latest = latest_encounter(usable)
    dirty = clean.accepted(registry.typed(spark, sf_dir))
    rules = {r.rule: r.violations for r in clean.dq_profile(dirty, registry.AS_OF).collect()}
    keys = ["patient_id", "admission_time"]
    top = usable.join(latest.select(keys), keys)
    tied = top.groupBy("patient_id").count().filter("count > 1").count()
    star = registry.star(spark, sf_dir)

    def by_gender(kpi, digits):
        return {r[0]: round(r[1], digits) for r in kpi(star).collect()}

    assert {
        "usable": usable.count(),
        "quarantined": clean.quarantine(registry.silver_rows(spark, sf_dir)).count(),
        "dirty_age": rules["dirty_age"],
        "future": rules["future_admission"],
        "latest": latest.count(),
        "tied": tied,
        "occupancy": by_gender(kpis.bed_occupancy, 3),
        "turnover": by_gender(kpis.bed_turnover_rate, 5),
        "admitted": by_gender(kpis.patient_demographics, 0),
        "groups": tuple(
            kpi(star).count()
            for kpi in (
                kpis.avg_treatment_duration,
                kpis.patient_volume_trend,
                kpis.department_inflow,
                kpis.overstay_patients,
            )
        ),
        "versions": registry.QUERIES["scd2_apply"](spark, sf_dir).count(),
    } == known


class FakeSession:
    def __init__(self, **conf):
        self.values = {f"spark.{k.replace('_', '.')}": v for k, v in conf.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.values.get(key, default)


def test_scratch_lies_in_the_shared_folder():
    path = scratch_dir(FakeSession(checkpoint_dir="hdfs://x/cp/", master="yarn"), "latest")
    assert path.startswith("hdfs://x/cp/wardstream/latest-")


def test_scratch_is_never_machine_local_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession(master="yarn"), "latest")
    assert "wardstream-" in scratch_dir(FakeSession(master="local[2]"), "latest")
