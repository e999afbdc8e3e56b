"""Built-in VM list prices used when no live price catalogue is available."""

from __future__ import annotations

# Fixed values (must equal the reference's for identical results): on-demand list prices
# for us-central1 as (node_type_id, vcpus, memory_gb, hourly_price_usd).  The machine type
# name equals the node type id for every seeded row.
SEED_VM_PRICES = [
    ("n1-standard-4", 4, 15.0, 0.190000),
    ("n1-standard-8", 8, 30.0, 0.380000),
    ("n1-standard-16", 16, 60.0, 0.760000),
    ("n1-standard-32", 32, 120.0, 1.520000),
    ("n1-standard-64", 64, 240.0, 3.040000),
    ("n1-standard-96", 96, 360.0, 4.560000),
    ("n1-highmem-4", 4, 26.0, 0.236000),
    ("n1-highmem-8", 8, 52.0, 0.473000),
    ("n1-highmem-16", 16, 104.0, 0.946000),
    ("n1-highmem-32", 32, 208.0, 1.892000),
    ("n1-highmem-64", 64, 416.0, 3.784000),
    ("n1-highmem-96", 96, 624.0, 5.676000),
    ("n2-standard-4", 4, 16.0, 0.194200),
    ("n2-standard-8", 8, 32.0, 0.388500),
    ("n2-standard-16", 16, 64.0, 0.776900),
    ("n2-standard-32", 32, 128.0, 1.553900),
    ("n2-standard-48", 48, 192.0, 2.330800),
    ("n2-standard-64", 64, 256.0, 3.107800),
    ("n2-standard-80", 80, 320.0, 3.884700),
    ("n2-highmem-4", 4, 32.0, 0.262000),
    ("n2-highmem-8", 8, 64.0, 0.524100),
    ("n2-highmem-16", 16, 128.0, 1.048200),
    ("n2-highmem-32", 32, 256.0, 2.096400),
    ("n2d-standard-4", 4, 16.0, 0.169000),
    ("n2d-standard-8", 8, 32.0, 0.338000),
    ("n2d-standard-16", 16, 64.0, 0.676000),
    ("n2d-standard-32", 32, 128.0, 1.352000),
    ("e2-standard-4", 4, 16.0, 0.134000),
    ("e2-standard-8", 8, 32.0, 0.268100),
    ("e2-standard-16", 16, 64.0, 0.536200),
    ("e2-standard-32", 32, 128.0, 1.072400),
    ("c2-standard-4", 4, 16.0, 0.208800),
    ("c2-standard-8", 8, 32.0, 0.417600),
    ("c2-standard-16", 16, 64.0, 0.835200),
    ("c2-standard-30", 30, 120.0, 1.566000),
    ("c2-standard-60", 60, 240.0, 3.132000),
]

# Approximate markup of seeded us-central1 prices per region; other regions 1.00.
REGION_MARKUP = {
    "us-central1": 1.00,
    "us-east1": 1.00,
    "us-west1": 1.00,
    "europe-west1": 1.10,
    "europe-west4": 1.10,
    "asia-south1": 1.16,
    "asia-south2": 1.16,
    "asia-east1": 1.12,
    "asia-southeast1": 1.14,
}

# price_source labels written into the price table (a markup label carries
# the markup factor; an estimate label is matched by the prefix 'Estimated').
SEED_LABEL = "GCP list price (seeded, %s)"
SEED_MARKUP_LABEL = "GCP list price (seeded us-central1, ~%sx markup for %s)"
CATALOG_LABEL = "GCP Cloud Billing Catalog API (%s)"
ESTIMATE_LABEL = "Estimated from GCP N1 component pricing"

# Component prices used to estimate an unlisted node type.
N1_VCPU_HOURLY = "0.04749"
N1_GB_HOURLY = "0.006383"
