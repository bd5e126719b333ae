"""The pipelines: event log in, warehouse tables out."""
