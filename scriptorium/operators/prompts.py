"""What outside models are asked: the texts around a segment, and the settings of a call."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptorium.operators.models import HttpBackend


@dataclass(frozen=True)
class Call:
    """A kind of call: the system's role, what stands around the segment, and sampling settings (None: the service's own)."""

    system: str
    before: str = ""
    after: str = ""
    temperature: float | None = None
    top_p: float | None = None
    max_tokens: int | None = None
    #: outer white space of an answer is dropped
    strip: bool = True
    #: the answer comes in pieces
    stream: bool = False

    def prompt(self, segment: Column) -> Column:
        """What the user says; null for a null segment."""
        return F.concat(F.lit(self.before), segment, F.lit(self.after))

    def messages(self, segment: Column) -> Column:
        """array<struct<role, content>>"""
        says = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
        return F.array(says("system", F.lit(self.system)), says("user", self.prompt(segment)))

    def backend(self, url: str, model: str) -> HttpBackend:
        return HttpBackend(url, model, self.system, temperature=self.temperature, top_p=self.top_p, max_tokens=self.max_tokens, strip=self.strip, stream=self.stream)


# What models are told, word for word. The numbers in them are as given.
CORRECT_SYSTEM = "你是一个专业的文本校对专家，负责修正OCR文本中的错误。请直接返回修正后的文本，不需要任何额外说明。"
CORRECT_BEFORE = "请帮我校对和修正以下OCR识别的文本，确保文字通顺、无错别字：\n\n"
PAIRS_SYSTEM = "你是一个专业的问答对生成专家。你的任务是生成尽可能多的高质量问答对，确保问题深入且多样，答案详尽且准确。"
PAIRS_BEFORE = """你是一个信息抽取能手，你需要把我给你的内容做成QA对，模拟人和大模型的对话，你的回复要满足下列要求：
                        全部使用中文回复
                        根据内容的几个主题返回至少810条符合的QA对，但不要重复说相同问题，
                        如果遇到里面提到几步法，你要合在一个回答里面
                        提问要模拟用户在这个知识点的提问主题下进行对话、提问要做到口语化并尽可能简单且不要涉及到具体的人，提问最好大于5个字少于0个字（格式类似：......怎么办，......为什么？），而回答应非常详细可分点回答、需要长回答详细紧扣我给你的东西，
                        因为我给你的材料是语音转文本，可能有错误，你要在基于上下文理解的基础上帮忙修复。
                        不要提到任何作者信息，只需要结合内容回答抽取。
                        最后只需要返回json list,严格遵守返回为json list格式：[{'input': ,'output': },{'input': ,'output': }]
            
                        文本内容：
                        """
PAIRS_AFTER = "\n                        "
CHUNK_SYSTEM = """你是一个信息抽取能手，你需要把我给你的内容做成QA对，模拟人和大模型的对话，你的回复要满足下列要求：
全部使用中文回复
根据内容的分类与系统返回QA对，至少20对，但不要重复说相同问题
格式要求：返回的json list中每个元素包含三个字段：instruction（问题）、output（答案）、system（角色设定）
system字段统一设置为：你是一个占卜和算命解释专家，你需要遵循文本标准来帮我解决相关问题
提问要专注于如何进行计算算卦以及结果，原因，解释等等方面,每遇到卦象就一定把这个卦象转化为一个QA对
因为我给你的材料是语音转文本，可能有错误，你要在基于上下文理解的基础上帮忙修复
不要提到任何作者信息，只需要结合内容回答抽取
回复格式示例：[
    {
        "instruction": "问题1",
        "output": "答案1",
        "system": "你是一个占卜和算命解释专家，你需要遵循文本标准来帮我解决相关问题"
    }
]"""

CORRECT = Call(CORRECT_SYSTEM, CORRECT_BEFORE, "", 0.3, 0.8, 2048)
PAIRS = Call(PAIRS_SYSTEM, PAIRS_BEFORE, PAIRS_AFTER, 0.7, 0.9, 4096)
CHUNK = Call(CHUNK_SYSTEM, strip=False, stream=True)
#: Seconds between two calls of one client.
PAUSE = 0.5
