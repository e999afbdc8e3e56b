"""Pins the seed and markup tables: the SQL twins read the same tables, so a wrong value
would not show there."""

from ledger.sources.seed import N1_GB_HOURLY, N1_VCPU_HOURLY, REGION_MARKUP, SEED_VM_PRICES


def test_seed_tables():
    assert len(SEED_VM_PRICES) == 36 and len({r[0] for r in SEED_VM_PRICES}) == 36
    assert sum(r[1] for r in SEED_VM_PRICES) == SUMS[0]
    assert round(sum(float(r[2]) for r in SEED_VM_PRICES), 3) == SUMS[1]
    assert round(sum(float(r[3]) for r in SEED_VM_PRICES), 6) == SUMS[2]
    assert len(REGION_MARKUP) == SUMS[3] and round(sum(map(float, REGION_MARKUP.values())), 4) == SUMS[4]
    assert (float(N1_VCPU_HOURLY), float(N1_GB_HOURLY)) == SUMS[5]


# vCPUs, GB, base prices; regions, markups; component prices.
SUMS = (990, 4695.0, 50.3298, 9, 9.78, (0.04749, 0.006383))
