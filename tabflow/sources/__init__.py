"""File sources and sinks, the shared folder, and the input tables."""
