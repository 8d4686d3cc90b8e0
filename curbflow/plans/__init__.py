from curbflow.plans.etl import run_etl
from curbflow.plans.merging import merge_increment
from curbflow.plans.scoring import predict, run_scoring
from curbflow.plans.training import TrainingResult, train_demand_model

__all__ = ["TrainingResult", "merge_increment", "predict", "run_etl", "run_scoring", "train_demand_model"]
