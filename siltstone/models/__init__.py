"""Adapters to models that live outside the engine, with deterministic stand-ins."""
