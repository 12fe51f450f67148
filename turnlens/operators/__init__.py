"""DataFrame operators: context windows, sampling, model annotation, topics, profiles, dashboard."""
