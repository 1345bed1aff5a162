from keyweave.functions.timecols import bucket_of, epoch_micros, window_micros
from keyweave.functions.order import arrival_before

__all__ = ["arrival_before", "bucket_of", "epoch_micros", "window_micros"]
