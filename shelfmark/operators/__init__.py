"""DataFrame operators: catalogue steps, reports, model output, index and search."""
