"""Jobs composed of operators: sync rounds, packaging, deployment."""
