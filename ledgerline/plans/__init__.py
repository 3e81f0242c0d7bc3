"""End-to-end jobs (silver batch, gold refresh, profile, split) and the
registry of named queries the driver runs."""
