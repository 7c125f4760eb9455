"""Schemas of the bank's entities."""

SKILLS = "skill_id int, skill_name string, additional_details string, subject_area string, subject string"
TASK_SKILLS = "skill_id int, task_name string"
COURSE_FRAMEWORK = "ord int, subject string, units array<struct<unit:string, weightage_percent:double, topics:array<struct<topic:string, objectives:array<variant>>>>>"
QUESTION = (
    "_id string, question_id string, question string, question_text string, multiple_choices array<string>, correct_answer string, level string, level_num int, skill string,"
    " skill_id int, skill_name string, subject string, subject_area string, subject_id int, subject_area_id int, model_name string, test_type string, question_type string,"
    " requires_diagram boolean, diagram_gen_steps array<string>, learning_objectives array<string>, created_at timestamp, batch_id string, question_index int, set_index int, hash string"
)
ENHANCED = "hints array<struct<level:int, hint:string>>, solution struct<steps:array<struct<step_number:int, explanation:string, verification:string, verification_success:boolean>>>, explanation_of_incorrect_options array<struct<option:string, explanation:string>>"
PAGE = "doc string, page_number int, text string"
ALIGNMENT = "doc string, question_num int, answer string, skill string, learning_objective string, unit int"
ANSWER_KEY = "doc string, row_ord int, cells array<string>"
RESPONSE = "request_id string, response string"
SEEN = "hash string"
VECTOR_RECORD = "question_id string, document string, embedding array<float>, topic string, keywords string, concepts string, difficulty string, semantic_context string"
