"""The migration jobs: export, load, reconcile, report, clean up."""
