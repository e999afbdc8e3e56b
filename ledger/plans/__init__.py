"""The pipelines: pricing, daily cost, VM cost, alerts, reports, and the batch jobs."""
