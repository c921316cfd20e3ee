"""voxlake: a PySpark-native engine for speech-corpus analytics."""

__version__ = "0.1.0"
